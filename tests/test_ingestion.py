"""Manifest, skip rule, failure runs and ready flags (the reference's ingestion cases)."""

from pyspark.sql import functions as F

from limelight.functions.labels import fetch_status, ready_flag
from limelight.operators.streaks import failure_runs
from limelight.sources.spines import calendar_days, expected_file_manifest, files_to_fetch


def test_manifest_96_per_feed_192_for_two(spark):
    days = calendar_days(spark, "2025-01-01", "2025-01-01")
    one = expected_file_manifest(days, {"regular": ".gkg.csv.zip"})
    two = expected_file_manifest(days)
    assert one.count() == 96 and two.count() == 192
    stamps = sorted(r.gdelt_timestamp for r in one.collect())
    assert stamps[0] == "20250101000000" and stamps[-1] == "20250101234500"
    r = two.filter("stream = 'translation'").orderBy("gdelt_timestamp").first()
    assert r.url == "http://data.gdeltproject.org/gdeltv2/20250101000000.translation.gkg.csv.zip"
    assert r.csv_path.endswith("date=2025-01-01/stream=translation/20250101000000.translation.gkg.csv")


def test_skip_rule_keeps_only_missing_or_empty(spark):
    days = calendar_days(spark, "2025-01-01", "2025-01-01")
    manifest = expected_file_manifest(days, {"regular": ".gkg.csv.zip"})
    present = spark.createDataFrame(
        [("regular", "20250101000000", 10), ("regular", "20250101001500", 0)],
        "stream string, gdelt_timestamp string, csv_size_bytes long")
    todo, skipped = files_to_fetch(manifest, present)
    assert todo.count() == 95
    s = skipped.collect()
    assert len(s) == 1 and s[0].download_status == "skipped" and s[0].csv_size_bytes == 10


def test_failure_run_sequence_below_limit(spark):
    seq = ["download_failed", "download_failed", "downloaded", "download_failed", "download_failed"]
    df = spark.createDataFrame([("w1", i, s) for i, s in enumerate(seq)], "worker string, i int, download_status string")
    out = failure_runs(df, ["worker"], ["i"], F.floor(F.col("i") / 3), limit=3).orderBy("i").collect()
    assert [r.failure_run for r in out] == [1, 2, 0, 1, 2]
    assert not any(r.breach for r in out)


def test_failure_run_skipped_neither_counts_nor_resets(spark):
    seq = ["download_failed", "skipped", "download_failed", "missing_upstream", "download_failed",
           "download_failed", "skipped", "download_failed"]
    df = spark.createDataFrame([("w1", i, s) for i, s in enumerate(seq)], "worker string, i int, download_status string")
    out = failure_runs(df, ["worker"], ["i"], F.floor(F.col("i") / 3), limit=3).orderBy("i").collect()
    assert [r.failure_run for r in out] == [1, 1, 2, 0, 1, 2, 2, 3]
    assert [r.breach for r in out][-1] is True


def test_remote_ready_flag(spark):
    df = spark.createDataFrame([("gs://b/x.csv",), (None,), ("",)], "gcp_url string")
    assert [r.r for r in df.select(ready_flag("remote").alias("r")).collect()] == [True, False, False]


def test_local_ready_flag(spark):
    df = spark.createDataFrame(
        [("skipped", None), ("downloaded", "extracted"), ("downloaded", "unzip_failed"), ("download_failed", None), (None, None)],
        "download_status string, unzip_status string")
    assert [r.r for r in df.select(ready_flag("local").alias("r")).collect()] == [True, True, False, False, False]


def test_fetch_status(spark):
    df = spark.createDataFrame([(404, "x"), (500, "x"), (200, None)], "code int, err string")
    got = [r.s for r in df.select(fetch_status("code", "err").alias("s")).collect()]
    assert got == ["missing_upstream", "download_failed", "downloaded"]
