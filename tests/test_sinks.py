"""Raw lines, partitioned sinks, JSON export, observed counts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from limelight.sinks.writers import (
    export_json,
    export_json_lines,
    observed_counts,
    write_partitioned_overwrite,
    write_year_snapshot,
)
from limelight.sinks.hydration import replace_partitions_from
from limelight.sources.raw_feed import raw_rows_from_lines
from limelight.sources.snapshots import read_day_summaries, read_union_by_name, read_yearly_snapshots


def test_raw_rows_from_lines(spark):
    lines = spark.createDataFrame([("1\t20250101000000\t1\tsrc",), ("2\t20250101001500",)], "line string")
    rows = raw_rows_from_lines(lines).orderBy("GKGRECORDID").collect()
    assert [(r.GKGRECORDID, r.DATE, r.SourceCommonName, r.Extras) for r in rows] == [
        ("1", "20250101000000", "src", None), ("2", "20250101001500", None, None)]


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "bronze")
    first = spark.createDataFrame([("a", "2025-01-01"), ("b", "2025-01-02")], "v string, d string")
    write_partitioned_overwrite(first, path, ["d"])
    write_partitioned_overwrite(spark.createDataFrame([("c", "2025-01-02")], "v string, d string"), path, ["d"])
    got = sorted((str(r.d), r.v) for r in spark.read.parquet(path).collect())
    assert got == [("2025-01-01", "a"), ("2025-01-02", "c")]


def test_year_snapshot_sorted_and_replaced(spark, tmp_path):
    root = str(tmp_path / "lake")
    df = spark.createDataFrame([("2024-03-01", 3), ("2024-01-01", 1), ("2025-01-01", 9)], "date string, views long") \
        .withColumn("date", F.col("date").cast("date"))
    write_year_snapshot(df, root, "wikipedia", "date", ["date"])
    write_year_snapshot(df.filter("year(date) = 2025").withColumn("views", F.lit(10).cast("long")), root, "wikipedia", "date", ["date"])
    got = sorted((str(r.date), r.views, r.year) for r in read_yearly_snapshots(spark, root, "wikipedia").collect())
    assert got == [("2024-01-01", 1, 2024), ("2024-03-01", 3, 2024), ("2025-01-01", 10, 2025)]


def read_array(folder):
    """The files of an exported array, one after another."""
    return json.loads("".join(open(os.path.join(folder, n), encoding="utf-8").read() for n in sorted(os.listdir(folder)) if n.endswith(".txt")))


def test_export_json_keeps_nulls_and_formats_dates(spark, tmp_path):
    df = spark.createDataFrame([("2025-01-05", None, "é"), ("2025-01-12", 2.5, "b")], "week_start string, v double, s string") \
        .withColumn("week_start", F.col("week_start").cast("date"))
    out = str(tmp_path / "weekly")
    export_json_lines(df, out, ["week_start"], ["week_start"])
    lines = []
    for name in sorted(os.listdir(out)):
        if name.endswith(".json"):
            lines += [json.loads(x) for x in open(os.path.join(out, name), encoding="utf-8") if x.strip()]
    want = [{"week_start": "2025-01-05", "v": None, "s": "é"}, {"week_start": "2025-01-12", "v": 2.5, "s": "b"}]
    assert lines == want
    array = str(tmp_path / "array")
    export_json(df.orderBy(F.desc("week_start")), array, ["week_start"], ["week_start"])
    assert read_array(array) == want
    export_json(df.limit(0), array, ["week_start"], ["week_start"])
    assert read_array(array) == []


def test_export_of_many_parts_is_one_array(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("id"), F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise("ä\n\"]").alias("s")).repartition(6)
    out = str(tmp_path / "array")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_json(df, out, [], ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len([n for n in os.listdir(out) if n.endswith(".txt")]) > 3
    assert [r["id"] for r in read_array(out)] == list(range(5000))


def test_observed_counts_in_one_pass(spark, tmp_path):
    df = spark.range(10).withColumn("bad", F.col("id") % 3 == 0)
    observed, obs = observed_counts(df, "run", rows=F.count(F.lit(1)), rejected=F.count_if("bad"))
    observed.write.mode("overwrite").parquet(str(tmp_path / "o"))
    assert obs.get == {"rows": 10, "rejected": 4}


def test_union_by_name_and_empty_summaries(spark, tmp_path):
    a, b = str(tmp_path / "logs" / "run=1"), str(tmp_path / "logs" / "run=2")
    spark.createDataFrame([(1, "x")], "id int, s string").write.parquet(a)
    spark.createDataFrame([(2, 3.5)], "id int, extra double").write.parquet(b)
    merged = read_union_by_name(spark, str(tmp_path / "logs"))
    assert set(merged.columns) >= {"id", "s", "extra", "run"} and merged.count() == 2
    assert read_day_summaries(spark, str(tmp_path / "missing")).count() == 0


def test_only_a_missing_path_reads_as_empty(spark, tmp_path):
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_day_summaries(spark, str(bad)).count()
    with pytest.raises(Exception, match="nofilesystem"):
        read_day_summaries(spark, "nofilesystem://x/y")
    with pytest.raises(FileNotFoundError):
        replace_partitions_from(spark, str(tmp_path / "none"), str(tmp_path / "t"), "d")


def test_a_large_year_is_written_in_order_by_several_tasks(spark, tmp_path):
    root = str(tmp_path / "lake")
    df = spark.range(20000).select(F.expr("date_add(date'2024-01-01', cast(id % 400 as int))").alias("date"), "id").repartition(5)
    write_year_snapshot(df, root, "x", "date", ["date", "id"])
    assert read_yearly_snapshots(spark, root, "x").count() == 20000
    files = sorted(os.listdir(os.path.join(root, "silver", "x", "year=2024")))
    rows = [spark.read.parquet(os.path.join(root, "silver", "x", "year=2024", f)).collect() for f in files if f.endswith(".parquet")]
    assert all(r == sorted(r) for r in rows)
