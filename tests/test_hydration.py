"""Partition replacement from a source lake (hydration)."""

import os

import pytest
from pyspark.sql import functions as F

from limelight.sinks import hydration
from limelight.sinks.hydration import replace_partitions_from


def write_day(spark, root, day, tag):
    df = spark.createDataFrame([(tag, day)], "v string, gkg_date string").withColumn("gkg_date", F.col("gkg_date").cast("date"))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("gkg_date").parquet(root)


def test_replaces_matching_partitions_only(spark, tmp_path):
    src, dst = str(tmp_path / "src" / "bronze"), str(tmp_path / "dst" / "bronze")
    write_day(spark, src, "2025-01-01", "new")
    write_day(spark, src, "2025-01-02", "two")
    open(os.path.join(src, "_SUCCESS"), "w").close()
    look_alike = str(tmp_path / "src" / "bronze_backup")
    write_day(spark, look_alike, "2025-01-01", "bad")
    write_day(spark, dst, "2025-01-01", "old")
    write_day(spark, dst, "2024-12-31", "untouched")

    assert replace_partitions_from(spark, src, dst, "gkg_date") == 2
    got = {str(r.gkg_date): r.v for r in spark.read.parquet(dst).collect()}
    assert got == {"2025-01-01": "new", "2025-01-02": "two", "2024-12-31": "untouched"}


def test_empty_source_fails_and_changes_nothing(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    os.makedirs(src)
    open(os.path.join(src, "_SUCCESS"), "w").close()
    write_day(spark, dst, "2024-12-31", "old")
    with pytest.raises(FileNotFoundError):
        replace_partitions_from(spark, src, dst, "gkg_date")
    assert [r.v for r in spark.read.parquet(dst).collect()] == ["old"]


def test_columns_of_any_source_file_arrive(spark, tmp_path):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    spark.createDataFrame([(1,)], "id int").write.parquet(f"{src}/d=1")
    spark.createDataFrame([(2, "x", 2.5)], "id long, extra string, v double").write.parquet(f"{src}/d=2")
    spark.createDataFrame([(3, 7)], "id int, v int").write.parquet(f"{src}/d=3")
    spark.createDataFrame([(9,)], "id int").write.parquet(f"{dst}/d=3")
    assert replace_partitions_from(spark, src, dst, "d") == 3
    got = sorted(map(tuple, spark.read.parquet(dst).select("d", "id", "extra", "v").collect()))
    assert got == [(1, 1, None, None), (2, 2, "x", 2.5), (3, 3, None, 7.0)]
    assert sorted(os.listdir(tmp_path)) == ["dst", "src"]  # neither staging nor backup stays


def contents(root):
    return sorted((os.path.relpath(os.path.join(d, f), root), open(os.path.join(d, f), "rb").read()) for d, _, fs in os.walk(root) for f in fs)


@pytest.mark.parametrize("fail_at", ["stage", "verify", 1, 2, 3, 4])
def test_a_failure_leaves_the_target_as_it_was(spark, tmp_path, monkeypatch, fail_at):
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    for day in ("2025-01-01", "2025-01-02"):
        write_day(spark, src, day, "new")
        write_day(spark, dst, day, "old")
    write_day(spark, dst, "2024-12-31", "old")
    before = contents(dst)
    if fail_at == "stage":
        monkeypatch.setattr(hydration, "read_reconciled", lambda s, p: s.read.parquet(p).withColumn("v", F.raise_error(F.lit("mid-copy"))))
    elif fail_at == "verify":
        monkeypatch.setattr(hydration, "_counts", lambda df, c, n=iter(range(9)): {"2025-01-01": next(n)})
    else:
        move, calls = hydration.Folders.move, []

        def broken(self, a, b):
            calls.append(a)
            if len(calls) == fail_at:
                raise hydration.HydrationError("mid-swap")
            move(self, a, b)

        monkeypatch.setattr(hydration.Folders, "move", broken)
    with pytest.raises(Exception, match="mid-copy|mid-swap|staged partitions differ"):
        replace_partitions_from(spark, src, dst, "gkg_date")
    assert contents(dst) == before and sorted(os.listdir(tmp_path)) == ["dst", "src"]
