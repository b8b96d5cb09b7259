"""Small inventory functions without an internal caller."""

import datetime as dt

from pyspark.sql import functions as F

from limelight.functions.dates import add_days, format_date
from limelight.functions.numeric import zero_default
from limelight.operators.filters import goals_in_played_weeks, not_in_list, split_bad_timestamp, threshold_split
from limelight.operators.filters import parse_timestamps
from limelight.operators.quality import check_one_to_one
from limelight.operators.sets import append_columns
from limelight.sinks.writers import widen_to_period, write_full_replace


def test_widen_to_period():
    assert widen_to_period("2024-05-03", "2024-06-01") == (dt.date(2024, 1, 1), dt.date(2024, 6, 1))
    assert widen_to_period("2023-05-03", "2024-06-01", "years") == (dt.date(2023, 1, 1), dt.date(2024, 12, 31))
    assert widen_to_period("2024-05-03", "2024-06-01", "history", "2020-01-01")[0] == dt.date(2020, 1, 1)


def test_full_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    write_full_replace(spark.createDataFrame([(2,), (1,)], "v int"), path, ["v"])
    write_full_replace(spark.createDataFrame([(3,)], "v int"), path)
    assert [r.v for r in spark.read.parquet(path).collect()] == [3]


def test_filters_and_columns(spark):
    df = spark.createDataFrame([("20240101000000", "fra", 50, 1, 2), ("bad", None, 30, 0, None), ("x", "eng", None, None, 1)],
                               "DATE string, lang string, minutes int, football_appearances int, football_goals int")
    good, bad = split_bad_timestamp(parse_timestamps(df))
    assert good.count() == 1 and bad.count() == 2
    assert [r.lang for r in df.filter(not_in_list("lang", ["fra", "spa"])).collect()] == ["eng"]
    hi, lo = threshold_split(df, "minutes", 45)
    assert (hi.count(), lo.count()) == (1, 2)  # a NULL counts as 0
    out = append_columns(df, {
        "g": goals_in_played_weeks(),
        "z": zero_default("football_goals"),
        "d": format_date(add_days(F.lit("2024-01-31").cast("date"), F.col("football_appearances"))),
    }).collect()
    assert [(r.g, r.z, r.d) for r in out] == [(2, 2, "2024-02-01"), (None, 0, "2024-01-31"), (None, 1, None)]


def test_one_to_one(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    right = spark.createDataFrame([(2,)], "k int")
    assert [(r.k, r.side) for r in check_one_to_one(left, right, ["k"]).collect()] == [(1, "left")]
