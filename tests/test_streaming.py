"""Incremental extraction picks up only new feed files."""

import os

from limelight.sources.raw_feed import GKG_COLUMNS
from limelight.streaming.incremental import start_incremental_extraction


def write(root, day, stream, name, rows):
    folder = os.path.join(root, f"date={day}", f"stream={stream}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        for values in rows:
            base = {c: "" for c in GKG_COLUMNS}
            base.update(values)
            f.write("\t".join(base[c] for c in GKG_COLUMNS) + "\n")


def run(spark, root, bronze, rejects, ck):
    for q in start_incremental_extraction(spark, root, bronze, rejects, checkpoint=ck):
        q.awaitTermination(120)


def test_incremental_extraction(spark, tmp_path):
    root, bronze, rejects, ck = (str(tmp_path / x) for x in ("lake", "bronze", "rejects", "ck"))
    write(root, "2025-01-01", "regular", "20250101000000.gkg.csv", [
        {"GKGRECORDID": "1", "DATE": "20250101000000", "Persons": "KYLIAN MBAPPE"},
        {"GKGRECORDID": "2", "DATE": "bad-date", "Persons": "KYLIAN MBAPPE"},
        {"GKGRECORDID": "3", "DATE": "20250101000000", "Persons": "SOMEONE ELSE"},
    ])
    run(spark, root, bronze, rejects, ck)
    assert sorted(r.GKGRECORDID for r in spark.read.parquet(bronze).collect()) == ["1"]
    write(root, "2025-01-02", "translation", "20250102000000.translation.gkg.csv", [
        {"GKGRECORDID": "4", "DATE": "20250102000000", "DocumentIdentifier": "https://x/mbappe"},
    ])
    run(spark, root, bronze, rejects, ck)
    got = sorted((r.GKGRECORDID, r.stream) for r in spark.read.parquet(bronze).collect())
    assert got == [("1", "regular"), ("4", "translation")]
    assert [r.GKGRECORDID for r in spark.read.parquet(rejects).collect()] == ["2"]
