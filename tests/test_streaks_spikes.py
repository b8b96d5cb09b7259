"""Chunked runs against the single-window form (with one hot key), the dashboard
streak semantics, and spike detection on a hand-made series."""

import datetime as dt
import random

from pyspark.sql import functions as F

from limelight.operators.spikes import SignalSpec, index_to_peak, signals_long, spikes_from_long
from limelight.operators.streaks import keyed_run, run_sum, zero_streak
from naive import keyed_run_naive


def js_scoreless(goals):
    out, s = [], 0
    for g in goals:
        s = 0 if g > 0 else s + 1
        out.append(s)
    return out


def js_goal_run(goals):
    out, s = [], 0
    for g in goals:
        s = 0 if g == 0 else s + g
        out.append(s)
    return out


def test_streaks_match_dashboard_semantics(spark):
    goals = [0, 0, 1, 0, 2, 3, 0, 0, 0, 1, 1]
    df = spark.createDataFrame([(1, i, g) for i, g in enumerate(goals)], "k int, i int, goals long") \
        .withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i") * 9))
    z = zero_streak(df, ["k"], ["d", "i"], F.col("goals") > 0, chunk=F.trunc("d", "month")).orderBy("i").collect()
    r = run_sum(df, ["k"], ["d", "i"], F.col("goals"), chunk=F.trunc("d", "month")).orderBy("i").collect()
    assert [x.zero_streak for x in z] == js_scoreless(goals)
    assert [x.run_sum for x in r] == js_goal_run(goals)


def test_null_amount_does_not_end_a_run(spark):
    df = spark.createDataFrame([(1, i, g) for i, g in enumerate([2, None, 3, 0, None, 1])], "k int, i int, g long")
    got = run_sum(df, ["k"], ["i"], F.col("g"), chunk=F.floor(F.col("i") / 2)).orderBy("i").collect()
    assert [r.run_sum for r in got] == [2, 2, 5, 0, 0, 1]


def test_chunked_equals_naive_with_hot_key(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(3000):
        key = 0 if i < 1000 else (None if i % 97 == 0 else rnd.randint(1, 60))
        rows.append((key, i, rnd.random() < 0.3, rnd.choice([0, 0, 1, 2]), i % 211 == 0))
    df = spark.createDataFrame(rows, "k int, i int, reset boolean, inc int, no_ts boolean") \
        .withColumn("ts", F.when(~F.col("no_ts"), F.timestamp_seconds(F.col("i") * 3600)))
    naive = keyed_run_naive(df, ["k"], ["ts", "i"], F.col("reset"), F.col("inc"), "v")
    chunked = keyed_run(df, ["k"], ["ts", "i"], F.col("reset"), F.col("inc"), "v", F.to_date("ts"))
    a = {(r.k, r.i): r.v for r in naive.collect()}
    b = {(r.k, r.i): r.v for r in chunked.collect()}
    assert a == b


def weekly_rows(values, start="2023-01-01"):
    s = dt.date.fromisoformat(start)
    return [(s + dt.timedelta(days=7 * i), v) for i, v in enumerate(values)]


def test_spike_needs_12_observations_and_strict_threshold(spark):
    values = [10.0] * 11 + [100.0] + [10.0] * 4 + [200.0]
    df = spark.createDataFrame([(w, "s", v) for w, v in weekly_rows(values)], "week_start date, signal string, signal_value double")
    got = spikes_from_long(df).collect()
    assert [(r.signal_value, r.baseline_observations) for r in got] == [(200.0, 16)]
    assert got[0].week_end == got[0].week_start + dt.timedelta(days=6)


def test_incomplete_weeks_are_null_but_occupy_slots(spark):
    rows = [(w, 7 if i != 3 else 5, float(i)) for i, (w, _) in enumerate(weekly_rows([0] * 6))]
    weekly = spark.createDataFrame(rows, "week_start date, days_in_period int, v double")
    long = signals_long(weekly, [SignalSpec("sig", "v")]).orderBy("week_start").collect()
    assert [r.signal_value for r in long] == [0.0, 1.0, 2.0, None, 4.0, 5.0]


def test_index_to_peak(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 10)], "w int, x int")
    got = {r.w: r.x_index for r in index_to_peak(df, ["x"]).collect()}
    assert got == {1: 50.0, 2: 0.0, 3: 100.0}
    zero = spark.createDataFrame([(1, 0), (2, None)], "w int, x int")
    assert [r.x_index for r in index_to_peak(zero, ["x"]).collect()] == [None, None]


def test_peak_lookup_scales_listed_signals_only(spark):
    from limelight.operators.spikes import peak_lookup
    weekly = spark.createDataFrame(
        [("2024-01-07", 50, 10), ("2024-01-14", 200, None), ("2024-01-21", None, 0)],
        "week_start string, interest long, views long").withColumn("week_start", F.col("week_start").cast("date"))
    spikes = spark.createDataFrame(
        [("2024-01-14", "google_trends_global_interest", 200.0), ("2024-01-07", "wikipedia_en_views", 10.0)],
        "week_start string, signal string, signal_value double").withColumn("week_start", F.col("week_start").cast("date"))
    got = {r.signal: r.display_value for r in peak_lookup(spikes, weekly, {"google_trends_global_interest": "interest"}).collect()}
    assert got == {"google_trends_global_interest": 100.0, "wikipedia_en_views": 10.0}
