"""Extraction on a tiny lake: candidate filter, bad timestamps, ignored files, two feeds."""

import os

from pyspark.sql import functions as F

from limelight.plans.pipeline import extract_candidates, extraction_counts
from limelight.sources.raw_feed import GKG_COLUMNS, read_feed_range, read_feed_range_lenient


def row(**values):
    base = {c: "" for c in GKG_COLUMNS}
    base.update(values)
    return "\t".join(base[c] for c in GKG_COLUMNS)


def write(root, day, stream, name, rows):
    folder = os.path.join(root, f"date={day}", f"stream={stream}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(rows) + "\n")


def make_lake(root):
    write(root, "2025-01-01", "regular", "20250101000000.gkg.csv", [
        row(GKGRECORDID="1", DATE="20250101000000", Persons="KYLIAN MBAPPE", DocumentIdentifier="https://a.example/x"),
        row(GKGRECORDID="2", DATE="20250101000000", Persons="OTHER PLAYER", DocumentIdentifier="https://a.example/y"),
        row(GKGRECORDID="3", DATE="bad-date", Persons="Kylian Mbappe", DocumentIdentifier="https://a.example/z"),
    ])
    write(root, "2025-01-01", "translation", "20250101000000.translation.gkg.csv", [
        row(GKGRECORDID="4", DATE="20250101001500", DocumentIdentifier="https://b.example/mbappe-news"),
    ])
    write(root, "2025-01-01", "regular", "ignored.tmp", [
        row(GKGRECORDID="5", DATE="20250101000000", Persons="KYLIAN MBAPPE"),
    ])
    write(root, "2025-01-03", "regular", "20250103000000.gkg.csv", [
        row(GKGRECORDID="6", DATE="20250103000000", Persons="KYLIAN MBAPPE"),
    ])


def test_extraction_end_to_end(spark, tmp_path):
    root = str(tmp_path / "lake")
    make_lake(root)
    raw, _ = read_feed_range_lenient(spark, root, "2025-01-01", "2025-01-02")
    good, bad = extract_candidates(raw, "mbapp")
    got = {r.GKGRECORDID: r for r in good.collect()}
    assert set(got) == {"1", "4"}
    assert got["1"].stream == "regular" and got["4"].stream == "translation"
    assert str(got["4"].gkg_date) == "2025-01-01"
    assert [r.GKGRECORDID for r in bad.collect()] == ["3"]
    counts = extraction_counts(raw, "mbapp").collect()[0]
    assert (counts.total_output_rows, counts.invalid_datetime_rows_skipped) == (2, 1)


def test_date_range_prunes_partitions(spark, tmp_path):
    root = str(tmp_path / "lake")
    make_lake(root)
    raw, _ = read_feed_range_lenient(spark, root, "2025-01-01", "2025-01-02")
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert raw.filter(F.col("feed_date") == "2025-01-03").count() == 0
    assert read_feed_range(spark, root, "2025-01-03", "2025-01-03", ["regular"]).count() == 1


def test_empty_fields_are_null(spark, tmp_path):
    root = str(tmp_path / "lake")
    make_lake(root)
    raw = read_feed_range(spark, root, "2025-01-01", "2025-01-01")
    r = raw.filter(F.col("GKGRECORDID") == "1").collect()[0]
    assert r.V2Persons is None and r.Persons == "KYLIAN MBAPPE"


def test_feed_tag_from_file_path(spark, tmp_path):
    from limelight.sources.raw_feed import read_raw_feed, source_tag_from_path
    root = str(tmp_path / "lake")
    make_lake(root)
    leaf_dirs = [os.path.join(root, "date=2025-01-01", f"stream={s}") for s in ("regular", "translation")]
    raw = read_raw_feed(spark, leaf_dirs).withColumn("stream", source_tag_from_path())
    got = sorted((r.GKGRECORDID, r.stream) for r in raw.collect())
    assert got == [("1", "regular"), ("2", "regular"), ("3", "regular"), ("4", "translation")]
