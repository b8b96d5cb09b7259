"""Completeness audit of the file-observation log.

The log has one row per expected upstream file per run (a few hundred rows
per day), so even years of history stay small; all steps are one-pass
aggregations with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limelight.functions.labels import day_status, ready_flag
from limelight.functions.numeric import BYTES_PER_GB, scale_round

FILE_KEY = ["stream", "gdelt_timestamp"]


def _flag(cond):
    return F.coalesce(cond, F.lit(False))


def collapse_observations(obs: DataFrame, mode: str = "local", key: list[str] = FILE_KEY,
                          run_col: str = "run_id") -> DataFrame:
    """A8 + F31 + F32: one row per upstream file. First date/URL by run order
    (deterministic), any-flags by ``bool_or``, max sizes, observation count."""
    flagged = obs.withColumns({
        "is_ready": ready_flag(mode),
        "was_downloaded": _flag(F.col("download_status") == "downloaded"),
        "was_skipped": _flag(F.col("download_status") == "skipped"),
        "had_404": _flag(F.col("http_status") == 404),
    })
    def first(name):  # first value that is there, by run; ties by the value itself
        return F.min_by(name, F.when(F.col(name).isNotNull(), F.struct(F.col(run_col).isNull(), F.col(run_col), F.col(name))))

    collapsed = flagged.groupBy(*key).agg(
        first("gdelt_date").alias("gdelt_date"),
        first("url").alias("url"),
        F.bool_or("was_downloaded").alias("was_downloaded"),
        F.bool_or("was_skipped").alias("was_skipped"),
        F.bool_or("had_404").alias("had_404"),
        F.max("zip_size_bytes").alias("zip_size_bytes"),
        F.max("csv_size_bytes").alias("csv_size_bytes"),
        F.count(F.lit(1)).alias("observations"),
        F.bool_or("is_ready").alias("is_ready"),
    )
    return collapsed.withColumns({
        "unresolved_404": F.col("had_404") & ~F.col("is_ready"),
        "zip_size_known": F.coalesce(F.col("zip_size_bytes"), F.lit(0)) > 0,
        "csv_size_known": F.coalesce(F.col("csv_size_bytes"), F.lit(0)) > 0,
    })


def audit_report(files: DataFrame) -> DataFrame:
    """A9 + F33: one-row global report over collapsed files."""
    r = files.agg(
        F.count(F.lit(1)).alias("files_expected"),
        F.count_if("was_downloaded").alias("files_downloaded"),
        F.count_if("is_ready").alias("files_ready"),
        F.count_if("had_404").alias("files_with_404"),
        F.count_if("unresolved_404").alias("files_unresolved_404"),
        F.coalesce(F.sum(F.coalesce("zip_size_bytes", F.lit(0))), F.lit(0)).alias("_zip"),
        F.coalesce(F.sum(F.coalesce("csv_size_bytes", F.lit(0))), F.lit(0)).alias("_csv"),
        F.count_if(F.col("is_ready") & ~F.col("zip_size_known")).alias("ready_without_zip_size"),
        F.count_if(F.col("is_ready") & ~F.col("csv_size_known")).alias("ready_without_csv_size"),
        F.coalesce(F.sum("observations"), F.lit(0)).alias("_obs"),
    )
    return r.select(
        "files_expected", "files_downloaded", "files_ready",
        (F.col("files_expected") - F.col("files_ready")).alias("files_not_ready"),
        F.round(F.col("files_ready") / F.nullif(F.col("files_expected"), F.lit(0)) * 100, 4).alias("ready_pct"),
        "files_with_404", "files_unresolved_404",
        scale_round("_zip", BYTES_PER_GB).alias("downloaded_zip_gb"),
        scale_round("_csv", BYTES_PER_GB).alias("extracted_csv_gb"),
        "ready_without_zip_size", "ready_without_csv_size",
        (F.col("_obs") - F.col("files_expected")).alias("repeated_observations_collapsed"),
    )


def audit_by_feed(files: DataFrame, feed_col: str = "stream") -> DataFrame:
    """A10: per-feed counts and volumes."""
    return files.groupBy(feed_col).agg(
        F.count(F.lit(1)).alias("files_expected"),
        F.count_if("was_downloaded").alias("files_downloaded"),
        F.count_if("is_ready").alias("files_ready"),
        F.count_if("unresolved_404").alias("files_unresolved_404"),
        scale_round(F.coalesce(F.sum("zip_size_bytes"), F.lit(0)), BYTES_PER_GB).alias("downloaded_zip_gb"),
        scale_round(F.coalesce(F.sum("csv_size_bytes"), F.lit(0)), BYTES_PER_GB).alias("extracted_csv_gb"),
    )


def audit_by_day(files: DataFrame, spine: DataFrame, date_col: str = "gdelt_date") -> DataFrame:
    """A11 + J6: per-day expected/ready/unresolved on a full calendar; missing days
    get 0 ready and 0 unresolved, while ``files_expected`` stays NULL."""
    daily = files.groupBy(F.col(date_col).alias("date")).agg(
        F.count(F.lit(1)).alias("files_expected"),
        F.count_if("is_ready").alias("files_ready"),
        F.count_if("unresolved_404").alias("files_unresolved_404"),
    )
    return spine.select("date").join(daily, "date", "left").fillna(0, subset=["files_ready", "files_unresolved_404"])


def with_day_status(by_day: DataFrame, full_day: int = 192) -> DataFrame:
    """P12 over ``audit_by_day``."""
    return by_day.withColumn(
        "day_status", day_status("files_ready", "files_unresolved_404", "files_expected", full_day)
    )


def size_profile(files: DataFrame) -> DataFrame:
    """Min / exact median / max of ready files with a known size, per size column."""
    def stats(col, known):
        v = F.when(F.col("is_ready") & F.col(known), F.col(col))
        return [F.min(v).alias(f"min_{col}"), F.median(v).alias(f"median_{col}"), F.max(v).alias(f"max_{col}")]

    return files.agg(*stats("zip_size_bytes", "zip_size_known"), *stats("csv_size_bytes", "csv_size_known"))


def full_day_profile(files: DataFrame, date_col: str = "gdelt_date") -> DataFrame:
    """Daily size totals of fully ready and fully sized days, then min/median/max."""
    daily = files.groupBy(date_col).agg(
        F.sum("zip_size_bytes").alias("zip"),
        F.sum("csv_size_bytes").alias("csv"),
        F.count(F.lit(1)).alias("files_expected"),
        F.count_if("is_ready").alias("files_ready"),
        F.count_if("zip_size_known").alias("zip_sizes_known"),
        F.count_if("csv_size_known").alias("csv_sizes_known"),
    )
    full = daily.filter(
        (F.col("files_ready") == F.col("files_expected"))
        & (F.col("zip_sizes_known") == F.col("files_expected"))
        & (F.col("csv_sizes_known") == F.col("files_expected"))
    )
    return full.agg(
        F.count(F.lit(1)).alias("full_days"),
        F.min("zip").alias("min_daily_zip"), F.median("zip").alias("median_daily_zip"), F.max("zip").alias("max_daily_zip"),
        F.min("csv").alias("min_daily_csv"), F.median("csv").alias("median_daily_csv"), F.max("csv").alias("max_daily_csv"),
    )


INGESTION_METRICS = [
    "files_expected", "files_download_skipped", "files_downloaded", "files_download_failed",
    "files_missing_upstream", "files_extracted", "files_unzip_failed", "files_ready", "files_not_ready",
    "days_processed",
]


def ingestion_metrics(obs: DataFrame, mode: str = "local") -> DataFrame:
    """The ten run metrics in one global aggregate; one row of zeros on empty input."""
    d, u = F.col("download_status"), F.col("unzip_status")
    ready = ready_flag(mode)
    return obs.agg(
        F.count(F.lit(1)).alias("files_expected"),
        F.count_if(d == "skipped").alias("files_download_skipped"),
        F.count_if(d == "downloaded").alias("files_downloaded"),
        F.count_if(d == "download_failed").alias("files_download_failed"),
        F.count_if(d == "missing_upstream").alias("files_missing_upstream"),
        F.count_if(u == "extracted").alias("files_extracted"),
        F.count_if(u == "unzip_failed").alias("files_unzip_failed"),
        F.count_if(ready).alias("files_ready"),
        F.count_if(~ready).alias("files_not_ready"),
        F.count_distinct("gdelt_date").alias("days_processed"),
    )
