"""Reading back what the sinks and the ingestion log wrote."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from limelight.sources.reconcile import read_reconciled

# The file-observation log (one row per expected upstream file per run).
OBSERVATION_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("stream", StringType()),
    StructField("gdelt_date", DateType()),
    StructField("gdelt_timestamp", StringType()),
    StructField("url", StringType()),
    StructField("csv_path", StringType()),
    StructField("zip_path", StringType()),
    StructField("download_status", StringType()),
    StructField("unzip_status", StringType()),
    StructField("http_status", IntegerType()),
    StructField("attempts", IntegerType()),
    StructField("zip_size_bytes", LongType()),
    StructField("csv_size_bytes", LongType()),
    StructField("download_started_at", TimestampType()),
    StructField("download_finished_at", TimestampType()),
    StructField("error_message", StringType()),
    StructField("gcp_url", StringType()),
])


def read_yearly_snapshots(spark: SparkSession, root: str, source: str) -> DataFrame:
    """The per-year files of one source as one table (``year`` from the path), with
    every column of any year, widened where years differ."""
    return read_reconciled(spark, f"{root.rstrip('/')}/silver/{source}")


def read_union_by_name(spark: SparkSession, pattern: str) -> DataFrame:
    """Run logs written with differing schemas, united by column name and widened."""
    return read_reconciled(spark, pattern)


def read_day_summaries(spark: SparkSession, path: str, schema: StructType = OBSERVATION_SCHEMA) -> DataFrame:
    """The per-day file summaries of a run; an empty table when there are none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
