"""Plan-shape checks for the properties the design relies on at scale."""

import re

from pyspark.sql import functions as F

from limelight.operators.dedup import dedup_keep_first
from limelight.operators.metrics import kpi_totals
from limelight.operators.spikes import index_to_peak, spikes_from_long
from limelight.operators.streaks import keyed_run

SF = "/root/testdata/sf0.01"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_is_a_two_phase_aggregate_not_a_window(spark):
    df = spark.createDataFrame([(1, "a", 3), (2, "a", 1), (3, "b", 2)], "id int, k string, o int")
    plan = plan_of(dedup_keep_first(df, "k", ["o", "id"]))
    assert "Window" not in plan
    assert len(re.findall(r"(SortAggregate|HashAggregate|ObjectHashAggregate)", plan)) >= 2
    assert "Exchange hashpartitioning(k" in plan


def test_global_measures_have_no_unpartitioned_window(spark):
    weekly = spark.createDataFrame([("2024-01-07", 7, 3, 1, 2, 0)], "week_start string, days_in_period int, a int, b int, v int, football_goals int") \
        .withColumn("week_start", F.col("week_start").cast("date"))
    assert "Window" not in plan_of(kpi_totals(weekly, ["a", "b"], ["v"]))
    assert "Window" not in plan_of(index_to_peak(weekly, ["a"]))
    assert "BroadcastExchange" in plan_of(index_to_peak(weekly, ["a"]))


def test_streak_windows_are_partitioned_by_key_and_chunk(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("i"), (F.col("id") % 5 == 0).alias("r"))
    plan = plan_of(keyed_run(df, ["k"], ["i"], F.col("r"), F.lit(1), "v", F.floor(F.col("i") / 10)))
    assert re.search(r"Exchange hashpartitioning\(k#\d+L?, _chunk#\d+L?", plan)


def test_spike_window_partitioned_by_signal(spark):
    df = spark.createDataFrame([("2024-01-07", "s", 1.0)], "week_start string, signal string, signal_value double") \
        .withColumn("week_start", F.col("week_start").cast("date"))
    plan = plan_of(spikes_from_long(df))
    assert "Window" in plan
    assert re.search(r"Exchange hashpartitioning\(signal#\d+", plan)


def test_scan_reads_only_needed_columns(spark):
    import __spark_entry__ as entry
    plan = plan_of(entry.queries()["pivot_by_key"](spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(x.split(":")[0] for x in schema.split(",")) == {"ts", "event_type", "value"}
