"""Generated spines.

Spines are generated on the executors from a one-row bounds table with
``sequence`` + ``explode``; nothing is built on the driver. Their size is
bounded by the period (days x slots x feeds), not by the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values that must equal the reference for equal results.
FILES_PER_DAY = 96
SLOT_MINUTES = 15
FEED_SUFFIXES = {
    "regular": ".gkg.csv.zip",
    "translation": ".translation.gkg.csv.zip",
}
FEED_BASE_URL = "http://data.gdeltproject.org/gdeltv2"


def _date(v) -> Column:
    return v.cast("date") if isinstance(v, Column) else F.lit(v).cast("date")


def bounds_frame(spark: SparkSession, start, end) -> DataFrame:
    if not isinstance(start, Column) and not isinstance(end, Column):
        s, e = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
        if s > e:
            raise ValueError("start date must not be after end date")
    return spark.range(1).select(_date(start).alias("start_date"), _date(end).alias("end_date"))


def calendar_spine(bounds: DataFrame, out: str = "date") -> DataFrame:
    """One row per day between ``start_date`` and ``end_date`` (inclusive) of a one-row table."""
    return bounds.select(F.explode(F.sequence("start_date", "end_date")).alias(out))


def calendar_days(spark: SparkSession, start, end, out: str = "date") -> DataFrame:
    return calendar_spine(bounds_frame(spark, start, end), out)


def interval_spine(bounds: DataFrame, days: int) -> DataFrame:
    """Inclusive fixed-size chunks ``(interval_start, interval_end)``; the last is clipped."""
    if days <= 0:
        raise ValueError("interval length must be positive")
    starts = bounds.select(
        F.explode(F.sequence("start_date", "end_date", F.make_interval(days=F.lit(days)))).alias("interval_start"),
        "end_date",
    )
    return starts.select(
        "interval_start",
        F.least(F.col("end_date"), F.date_add("interval_start", days - 1)).alias("interval_end"),
    )


def expected_file_manifest(days: DataFrame, feeds: dict[str, str] = FEED_SUFFIXES, date_col: str = "date",
                           files_per_day: int = FILES_PER_DAY, slot_minutes: int = SLOT_MINUTES,
                           base_url: str = FEED_BASE_URL, root: str = "tmp/gdelt_gkg",
                           run_id: str | None = None) -> DataFrame:
    """``files_per_day`` slots per day and feed -> timestamp, file name, URL, paths.

    Feeds are a literal list, exploded in the projection (no join)."""
    feed_structs = F.array(*[F.struct(F.lit(k).alias("stream"), F.lit(v).alias("suffix")) for k, v in feeds.items()])
    day_ts = F.col(date_col).cast("timestamp")
    last = day_ts + F.make_interval(mins=F.lit(slot_minutes * (files_per_day - 1)))
    slots = days.select(
        F.col(date_col).alias("gdelt_date"),
        F.explode(F.sequence(day_ts, last, F.make_interval(mins=F.lit(slot_minutes)))).alias("slot"),
    )
    rows = slots.select("gdelt_date", "slot", F.inline(feed_structs))
    ts_text = F.date_format("slot", "yyyyMMddHHmmss")
    file_name = F.concat(ts_text, F.col("suffix"))
    stream_dir = F.concat_ws("/", F.lit(root), F.concat(F.lit("date="), F.date_format("gdelt_date", "yyyy-MM-dd")),
                             F.concat(F.lit("stream="), F.col("stream")))
    out = rows.select(
        F.lit(run_id).cast("string").alias("run_id"),
        "stream",
        "gdelt_date",
        ts_text.alias("gdelt_timestamp"),
        file_name.alias("file_name"),
        F.concat(F.lit(base_url.rstrip("/") + "/"), file_name).alias("url"),
        F.concat_ws("/", stream_dir, file_name).alias("zip_path"),
        F.concat_ws("/", stream_dir, F.regexp_replace(file_name, r"\.zip$", "")).alias("csv_path"),
    )
    return out


def files_to_fetch(manifest: DataFrame, present: DataFrame, key: list[str] | None = None,
                   size_col: str = "csv_size_bytes") -> tuple[DataFrame, DataFrame]:
    """(files still to download, files already present with size > 0 marked ``skipped``).

    ``present`` is a listing of existing files (e.g. a ``binaryFile`` scan without
    content, or the observation log) with the key columns and a size."""
    key = key or ["stream", "gdelt_timestamp"]
    ready = present.filter(F.col(size_col) > 0).groupBy(*key).agg(F.max(size_col).alias(size_col))
    todo = manifest.join(ready, key, "left_anti")
    skipped = manifest.join(ready, key, "inner").withColumn("download_status", F.lit("skipped"))
    return todo, skipped
