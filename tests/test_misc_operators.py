"""Remaining inventory items: lenient range read, rename/normalise, tagged union,
request URLs, check suite enforcement."""

import os

import pytest
from pyspark.sql import functions as F

from limelight.functions.urls import article_url, pageviews_url
from limelight.operators.filters import exclude_category, rename_normalize
from limelight.operators.quality import CheckFailed, CheckSpec, enforce, run_checks
from limelight.operators.sets import concat_tagged
from limelight.sources.raw_feed import GKG_COLUMNS, read_feed_range, read_feed_range_lenient


def write(root, day, stream, name, values):
    folder = os.path.join(root, f"date={day}", f"stream={stream}")
    os.makedirs(folder, exist_ok=True)
    base = {c: "" for c in GKG_COLUMNS}
    base.update(values)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\t".join(base[c] for c in GKG_COLUMNS) + "\n")


def test_lenient_range_reports_missing_days(spark, tmp_path):
    root = str(tmp_path / "lake")
    write(root, "2025-01-01", "regular", "a.gkg.csv", {"GKGRECORDID": "1", "DATE": "20250101000000"})
    write(root, "2025-01-03", "regular", "b.gkg.csv", {"GKGRECORDID": "2", "DATE": "20250103000000"})
    data, missing = read_feed_range_lenient(spark, root, "2025-01-01", "2025-01-03", ["regular"])
    assert sorted(r.GKGRECORDID for r in data.collect()) == ["1", "2"]
    assert [str(r.feed_date) for r in missing.collect()] == ["2025-01-02"]
    with pytest.raises(FileNotFoundError):
        read_feed_range_lenient(spark, root, "2025-02-01", "2025-02-03", ["regular"])
    with pytest.raises(FileNotFoundError, match="2025-01-02/regular"):
        read_feed_range(spark, root, "2025-01-01", "2025-01-03", ["regular"])
    os.makedirs(os.path.join(root, "date=2025-01-04", "stream=regular"))  # a folder without feed files is missing too
    with pytest.raises(FileNotFoundError, match="2025-01-04/regular"):
        read_feed_range(spark, root, "2025-01-03", "2025-01-04", ["regular"])


def test_rename_normalize_and_exclude(spark):
    df = spark.createDataFrame([("Cup", "12", "x"), (None, " 3 ", "1"), ("UEFA Youth League", "1", "2")],
                               "comp string, mins string, goals string")
    out = rename_normalize(df, {"comp": "competition", "mins": "total_time"}, ["total_time", "goals"],
                           ["competition", "total_time", "goals"])
    kept = exclude_category(out, "competition", "UEFA Youth League").collect()
    assert [(r.competition, r.total_time, r.goals) for r in kept] == [("Cup", 12, None), (None, 3, 1)]


def test_concat_tagged(spark):
    a = spark.createDataFrame([(1,)], "views long")
    b = spark.createDataFrame([(2,)], "views long")
    got = sorted((r.language, r.views) for r in concat_tagged({"en": a, "fr": b}, "language").collect())
    assert got == [("en", 1), ("fr", 2)]


def test_encode_title_matches_quote(spark):
    from urllib.parse import quote

    from limelight.functions.urls import encode_title
    titles = ["Kylian Mbappé", "a/b c", "x~y*z", "100% + more", "Ñandú (ave)", "it's", "a&b=c?d#e"]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = [r.e for r in df.select(encode_title("t").alias("e")).collect()]
    assert got == [quote(t) for t in titles]


def test_request_urls(spark):
    df = spark.createDataFrame([("Kylian Mbappé", "fr")], "t string, l string") \
        .withColumn("s", F.lit("2024-01-01").cast("date")).withColumn("e", F.lit("2024-01-31").cast("date"))
    r = df.select(article_url("t", "l").alias("a"), pageviews_url("t", "l", "s", "e").alias("p")).collect()[0]
    assert r.a == "https://fr.wikipedia.org/wiki/Kylian%20Mbapp%C3%A9"
    assert r.p.endswith("/fr.wikipedia.org/all-access/user/Kylian%20Mbapp%C3%A9/daily/2024010100/2024013100")


def test_enforce_blocks_on_violation(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    res = run_checks(df, [CheckSpec("k_not_null", "not_null", ["k"]), CheckSpec("k_unique", "unique", ["k"])])
    assert {r.check_name: r.violations for r in res.collect()} == {"k_not_null": 1, "k_unique": 1}
    with pytest.raises(CheckFailed):
        enforce(res)


def test_dedup_with_metrics_counts_in_one_pass(spark):
    from limelight.operators.dedup import dedup_with_metrics
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "o int, k string")
    out, before, after = dedup_with_metrics(df, "k", ["o"])
    got = sorted((r.k or "", r.o) for r in out.collect())
    assert got == [("", 4), ("", 5), ("a", 1), ("b", 3)]
    assert before.get == {"candidate_rows": 5} and after.get == {"retained_rows": 4}


def test_dedup_hot_key_keeps_the_first_row(spark):
    from limelight.operators.dedup import dedup_keep_first
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (3000 - F.col("id")).alias("o"), F.col("id"))
    out = dedup_keep_first(df.repartition(8), "k", ["o", "id"])
    hot = out.filter("k = 'hot'").collect()
    assert out.count() == 2001 and [(r.o, r.id) for r in hot] == [(3, 2997)]
