"""The NULL rules of SURVEY 1.4 on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from limelight.operators.metrics import Segment, daily_filtered_metrics, weekly_rollup
from limelight.operators.spikes import spikes_from_long
from limelight.plans import pipeline as P

D = dt.date(2024, 1, 7)


def test_null_tone_is_on_neither_side_of_the_negative_share(spark):
    df = spark.createDataFrame([(D, "regular", -1.0), (D, "regular", None), (D, "regular", 2.0)],
                               "gkg_date date, stream string, tone double")
    r = daily_filtered_metrics(df, segments=[Segment("english", "stream = 'regular'")]).collect()[0]
    assert (r.english_coverage, r.english_avg_tone, r.english_negative_share) == (3, 0.5, 0.5)


def test_weighted_mean_over_zero_coverage_is_null_and_availability_counts_days(spark):
    daily = spark.createDataFrame([(D, 0, None), (D + dt.timedelta(days=1), None, None)],
                                  "date date, cov long, tone double")
    r = weekly_rollup(daily, ["cov", "tone"], {"tone": "cov"}, {"days_available": "cov"}).collect()[0]
    assert (r.days_in_period, r.days_available, r.cov, r.tone) == (2, 1, 0, None)


def test_ratio_to_zero_median_is_null(spark):
    rows = [(D + dt.timedelta(days=7 * i), "s", 0.0) for i in range(12)] + [(D + dt.timedelta(days=84), "s", 5.0)]
    df = spark.createDataFrame(rows, "week_start date, signal string, signal_value double")
    r = spikes_from_long(df).collect()
    assert len(r) == 1 and r[0].baseline_median == 0.0 and r[0].spike_ratio is None


def test_missing_feed_days_stay_null_and_match_metrics_become_zero(spark):
    pageviews = spark.createDataFrame([(D, "en", 5), (D + dt.timedelta(days=1), "en", 0)],
                                      "date date, language string, views long")
    daily = spark.createDataFrame([(D, 3)], "date date, english_coverage long")
    matches = spark.createDataFrame(
        [("Cup", D, "A", "1:0", "B", 90, 1, 0, 0, 0, 0),
         ("Cup", D + dt.timedelta(days=1), "A", "0:0", "B", None, 0, 0, 0, 0, 0)],
        "competition string, match_date date, team1 string, score string, team2 string, total_time long, "
        "goals long, penalties long, missed_penalties long, yellow_cards long, red_cards long")
    out = {r.date: r for r in P.gold_daily(daily, pageviews, matches).collect()}
    assert out[D].english_coverage == 3 and out[D].football_appearances == 1 and out[D].football_goals == 1
    nxt = out[D + dt.timedelta(days=1)]
    assert nxt.english_coverage is None and nxt.football_appearances == 0 and nxt.football_minutes == 0
    played = P.gold_matches(matches, P.gold_daily(daily, pageviews, matches)).collect()
    assert [r.date for r in played] == [D]
