"""Sinks (K1-K8, K10, O4; K9 is in ``hydration``).

Writes are idempotent re-runs: partitioned tables use dynamic partition
overwrite, so a run replaces exactly the partitions it produced and leaves
every other partition alone; a task lost mid-write is retried by Spark and the
commit protocol publishes only complete task output. Row counts that the
reference got from extra jobs are collected with ``Observation`` during the
write itself.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from limelight.session import checkpointed


def write_partitioned_overwrite(df: DataFrame, path: str, partition_cols: list[str], compact: bool = True,
                                fmt: str = "parquet") -> None:
    """K1 + K2: replace only the touched partitions. ``compact`` asks AQE to
    rebalance rows by the partition columns before the write: few files per
    partition, and a partition too large for one task is split instead of
    forcing the whole day through one writer (as ``coalesce(1)`` would)."""
    out = df.hint("rebalance", *partition_cols) if compact else df
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(fmt).save(path))


def widen_to_period(start, end, mode: str = "year", history_start=None) -> tuple[dt.date, dt.date]:
    """K4: widen a requested range before a whole-period replace: ``year`` -> Jan 1
    of the start year to the end date, ``years`` -> whole years, ``history`` ->
    from ``history_start``."""
    s, e = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    if mode == "year":
        return dt.date(s.year, 1, 1), e
    if mode == "years":
        return dt.date(s.year, 1, 1), dt.date(e.year, 12, 31)
    if mode == "history":
        return dt.date.fromisoformat(str(history_start)), e
    raise ValueError(f"unknown widening mode {mode}")


def year_of(date_col: str) -> Column:
    """K4 as a column: the year partition of a date."""
    return F.year(F.col(date_col))


def write_year_snapshot(df: DataFrame, root: str, source: str, date_col: str, sort_columns: list[str]) -> None:
    """K3 + O4: per-source table partitioned by year, each year replaced whole,
    rows sorted inside every file. Rows are dealt by ranges of (year, sort columns),
    so a large year is written by several tasks whose files follow one another."""
    out = df.withColumn("year", year_of(date_col)).repartitionByRange("year", *sort_columns)
    out = out.sortWithinPartitions("year", *sort_columns)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year").parquet(f"{root.rstrip('/')}/silver/{source}"))


def write_full_replace(df: DataFrame, path: str, sort_columns: list[str] | None = None) -> None:
    """K5: whole-history replace (values are re-normalised on every request)."""
    out = df.sortWithinPartitions(*sort_columns) if sort_columns else df
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_silver(df: DataFrame, path: str) -> None:
    """K6."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def materialize_gold(df: DataFrame, path: str, order_by: list[str] | None = None) -> None:
    """K7: gold tables as Parquet, range-ordered so the files read back in order."""
    out = df.orderBy(*order_by) if order_by else df
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def export_json(df: DataFrame, path: str, date_cols: list[str], order_by: list[str], decimals: int = 15) -> None:
    """K8: one ordered JSON array of records, as the dashboard loads it: dates as
    ``YYYY-MM-DD``, doubles with at most ``decimals`` decimal places, NULL fields
    kept, one record a line.

    The records are range-sorted and written by tasks, a file a part; the files one
    after another (by name) are one array. The sorted rows are checkpointed, which fixes
    their parts; brackets and commas are placed by part number and place in the part, from
    one row a part with its number of records."""
    rows = _json_rows(df, date_cols, decimals)
    record = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")
    ordered = checkpointed(rows.orderBy(*order_by).select(record))
    at = F.monotonically_increasing_id()
    placed = ordered.select("value", F.spark_partition_id().alias("part"), at.bitwiseAND(F.lit(2**33 - 1)).alias("place"))
    counts = sorted((r.part, r.n) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())
    if not counts:
        df.sparkSession.range(1).select(F.lit("[]").alias("value")).write.mode("overwrite").text(path)
        return
    first = (F.col("part") == counts[0][0]) & (F.col("place") == 0)
    last = (F.col("part") == counts[-1][0]) & (F.col("place") == counts[-1][1] - 1)
    line = F.concat(F.when(first, "[").otherwise(""), F.col("value"), F.when(last, "]").otherwise(","))
    placed.select(line.alias("value")).write.mode("overwrite").text(path)


def export_json_lines(df: DataFrame, path: str, date_cols: list[str], order_by: list[str], decimals: int = 15) -> None:
    """K8 for tables of any size: the same records as JSON lines, written by the
    executors (``orderBy`` range-partitions, so part files are in order)."""
    out = _json_rows(df, date_cols, decimals).orderBy(*order_by)
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _json_rows(df: DataFrame, date_cols: list[str], decimals: int) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    out = df.withColumns({c: F.round(F.col(c), decimals) for c in doubles})
    return out.withColumns({c: F.date_format(F.col(c), "yyyy-MM-dd") for c in date_cols})


def observed_counts(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach named aggregate metrics computed during the next action on the
    returned DataFrame (read ``obs.get`` afterwards); no second job."""
    obs = Observation(name)
    return df.observe(obs, *[m.alias(k) for k, m in metrics.items()]), obs
