"""Incremental candidate extraction with Structured Streaming.

The reference has no unbounded streams: new feed files are picked up by
re-running extraction over a date range and overwriting the touched
partitions. The same work as a file stream: ``readStream`` over the raw feed
folder (explicit schema, ``*.gkg.csv`` only) applies the candidate filter and
timestamp parsing, and a Parquet file sink appends each micro-batch to the
date-partitioned bronze table. The source's checkpoint remembers which files
were processed, so a restarted or re-triggered job reads only new files;
``availableNow`` runs it as a batch over what is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from limelight.plans.pipeline import REFERENCE_TOKEN
from limelight.operators.filters import any_column_contains, parse_timestamps
from limelight.sources.raw_feed import (
    BRONZE_COLUMNS,
    FEED_READ_SCHEMA,
    FILE_GLOB,
    SEARCH_TEXT_COLUMNS,
    restore_feed_columns,
)


def raw_feed_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (
        spark.readStream.schema(FEED_READ_SCHEMA)
        .option("sep", "\t").option("header", "false").option("quote", "").option("escape", "")
        .option("pathGlobFilter", FILE_GLOB)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return restore_feed_columns(reader.csv(root))


def candidate_stream(raw: DataFrame, token: str = REFERENCE_TOKEN) -> DataFrame:
    parsed = parse_timestamps(raw.filter(any_column_contains(SEARCH_TEXT_COLUMNS, token)))
    return parsed.withColumn("_valid", F.col("gkg_datetime").isNotNull())


def start_incremental_extraction(spark: SparkSession, root: str, bronze_path: str, rejects_path: str | None = None,
                                 *, checkpoint: str, token: str = REFERENCE_TOKEN,
                                 available_now: bool = True) -> list[StreamingQuery]:
    """New candidates go to bronze (Parquet file sink partitioned by ``gkg_date``;
    the sink's commit log makes every micro-batch land exactly once even when a
    batch is retried); rows with unparseable timestamps go to ``rejects_path``.
    ``checkpoint`` is a folder on shared storage that outlives the session: it
    remembers which files were read, so a restarted job must be given the same one."""
    base = checkpoint.rstrip("/")
    candidates = candidate_stream(raw_feed_stream(spark, root), token)

    def start(df: DataFrame, path: str, name: str, partition: list[str]) -> StreamingQuery:
        w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{base}/{name}")
        if partition:
            w = w.partitionBy(*partition)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 minutes")
        return w.start()

    queries = [start(candidates.filter("_valid").select(*BRONZE_COLUMNS), bronze_path, "bronze", ["gkg_date"])]
    if rejects_path:
        queries.append(start(candidates.filter(~F.col("_valid")).drop("_valid"), rejects_path, "rejects", []))
    return queries
