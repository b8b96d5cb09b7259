"""Spike detection over weekly signals.

The weekly table is one row per week, so everything after the weekly rollup
is small by construction: its row count is bounded by the number of weeks in
the period times the number of signals, not by the input volume. The window
is partitioned by signal, so parallelism equals the number of signals.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limelight.functions.dates import week_end
from limelight.functions.labels import signal_group
from limelight.functions.numeric import safe_ratio
from limelight.operators.filters import complete_period_gate, spike_predicate
from limelight.operators.streaks import numbered

# Fixed values that must equal the reference for equal results.
BASELINE_WEEKS = 52
BLOCK_ROWS = 5200  # rows of one series in a task where a chunk is given
MIN_OBSERVATIONS = 12
FENCE_FACTOR = 3


@dataclass(frozen=True)
class SignalSpec:
    """One weekly series: output name, source column and the SQL gate for a complete week."""

    signal: str
    column: str
    gate: str = "days_in_period = 7"


# The reference's nine weekly signals; media ones also need seven feed days.
REFERENCE_SIGNALS = [
    SignalSpec("gdelt_english_coverage", "english_coverage", "days_in_period = 7 and gdelt_days_available = 7"),
    SignalSpec("gdelt_french_coverage", "translated_french_coverage", "days_in_period = 7 and gdelt_days_available = 7"),
    SignalSpec("gdelt_spanish_coverage", "translated_spanish_coverage", "days_in_period = 7 and gdelt_days_available = 7"),
    SignalSpec("wikipedia_en_views", "wikipedia_en_views"),
    SignalSpec("wikipedia_fr_views", "wikipedia_fr_views"),
    SignalSpec("wikipedia_es_views", "wikipedia_es_views"),
    SignalSpec("google_trends_global_interest", "google_trends_global_avg_interest"),
    SignalSpec("google_trends_fr_interest", "google_trends_fr_avg_interest"),
    SignalSpec("google_trends_es_interest", "google_trends_es_avg_interest"),
]

REFERENCE_CONTEXT = [
    "english_coverage", "english_avg_tone", "english_negative_share",
    "english_high_salience_coverage", "english_high_salience_avg_tone", "english_high_salience_negative_share",
    "translated_coverage", "translated_avg_tone", "translated_negative_share",
    "wikipedia_en_views", "wikipedia_fr_views", "wikipedia_es_views",
    "google_trends_global_avg_interest", "google_trends_fr_avg_interest", "google_trends_es_avg_interest",
    "football_appearances", "football_minutes", "football_goals",
]


def signals_long(weekly: DataFrame, specs: list[SignalSpec], week_col: str = "week_start") -> DataFrame:
    """U1 + P7: wide weekly columns -> (week, signal, signal_value) in one scan (Expand),
    incomplete weeks kept as NULL values so they still occupy a window slot."""
    gated = weekly.select(
        F.col(week_col),
        *[complete_period_gate(s.column, F.coalesce(F.expr(s.gate), F.lit(False))).alias(s.signal) for s in specs],
    )
    return gated.unpivot([week_col], [s.signal for s in specs], "signal", "signal_value")


def rolling_baseline(long: DataFrame, key: str = "signal", order: str = "week_start",
                     weeks: int = BASELINE_WEEKS, value: str = "signal_value",
                     chunk: Column | None = None, block: int = BLOCK_ROWS) -> DataFrame:
    """Count / median / Q1 / Q3 over the ``weeks`` preceding rows (current excluded).

    ``percentile`` is exact and interpolating, as ``quantile_cont``; ``median``
    and ``percentile_cont`` are not allowed with a row frame.

    Without ``chunk`` one window per key sorts each series in one task, as fits a row a
    week. With ``chunk`` (monotone in ``order``, e.g. the day of a timestamp) a series of
    any length spans many tasks: rows are numbered by a chunked scan and dealt to blocks of
    ``block`` places; the last ``weeks`` rows of a block also go to the next one, where they
    only serve as the frame of its first rows."""
    placed, part, by = long, [key], order
    if chunk is not None:
        if block < weeks:
            raise ValueError("a block must hold at least one whole frame")
        placed = numbered(long, key, order, chunk)
        at = F.col("_place") - 1
        own = F.floor(at / block)
        lent = F.when(at % block >= block - weeks, F.array(own, own + 1)).otherwise(F.array(own))
        placed = placed.withColumn("_own", own).withColumn("_block", F.explode(lent))
        part, by = [key, "_block"], "_place"
    w = Window.partitionBy(*part).orderBy(by).rowsBetween(-weeks, -1)
    v = F.col(value)
    scored = placed.withColumns({
        "baseline_observations": F.count(v).over(w),
        "baseline_median": F.percentile(v, F.lit(0.5)).over(w),
        "baseline_q1": F.percentile(v, F.lit(0.25)).over(w),
        "baseline_q3": F.percentile(v, F.lit(0.75)).over(w),
    })
    return scored if chunk is None else scored.where("_block = _own").drop("_place", "_own", "_block")


def tukey_upper_fence(q1: str = "baseline_q1", q3: str = "baseline_q3", factor: float = FENCE_FACTOR):
    """``q3 + factor * (q3 - q1)``."""
    return F.col(q3) + F.lit(factor) * (F.col(q3) - F.col(q1))


def scored_signals(long: DataFrame, weeks: int = BASELINE_WEEKS, factor: float = FENCE_FACTOR,
                   key: str = "signal", order: str = "week_start", chunk: Column | None = None) -> DataFrame:
    return rolling_baseline(long, key, order, weeks, chunk=chunk).withColumn("spike_threshold", tukey_upper_fence(factor=factor))


def spikes_from_long(long: DataFrame, weeks: int = BASELINE_WEEKS, min_observations: int = MIN_OBSERVATIONS,
                     factor: float = FENCE_FACTOR, key: str = "signal", order: str = "week_start",
                     group_prefixes=None, with_week_end: bool = True, chunk: Column | None = None) -> DataFrame:
    """W2 + W3 + P8 + F20-F22 on an already long series table; ``chunk`` as in ``rolling_baseline``."""
    scored = scored_signals(long, weeks, factor, key, order, chunk).filter(spike_predicate(min_observations))
    group = signal_group(key) if group_prefixes is None else signal_group(key, group_prefixes)
    cols = [F.col(order)]
    if with_week_end:
        cols.append(week_end(order).alias("week_end"))
    return scored.select(
        *cols,
        group.alias("signal_group"),
        F.col(key),
        "signal_value",
        "baseline_observations",
        "baseline_median",
        "spike_threshold",
        safe_ratio("signal_value", "baseline_median").alias("spike_ratio"),
    )


def detect_spikes(weekly: DataFrame, specs: list[SignalSpec] = REFERENCE_SIGNALS,
                  context: list[str] | None = REFERENCE_CONTEXT, weeks: int = BASELINE_WEEKS,
                  min_observations: int = MIN_OBSERVATIONS, factor: float = FENCE_FACTOR,
                  week_col: str = "week_start", group_prefixes=None) -> DataFrame:
    """Signal-level spikes with weekly context columns (J3), one row per (week, signal)."""
    spikes = spikes_from_long(signals_long(weekly, specs, week_col), weeks, min_observations, factor,
                              order=week_col, group_prefixes=group_prefixes)
    if context:
        spikes = spike_context(spikes, weekly, context, week_col)
    return spikes


def spike_context(spikes: DataFrame, weekly: DataFrame, context: list[str], week_col: str = "week_start") -> DataFrame:
    """Inner join on the week for context columns. Both sides are one row per
    week (per signal); AQE turns this into a broadcast join from runtime sizes."""
    return spikes.join(weekly.select(week_col, *context), week_col, "inner")


def spike_week_summary(spikes: DataFrame, week_col: str = "week_start") -> DataFrame:
    """Per week the number of signal groups, signals and the largest ratio (NULL as 0)."""
    return spikes.groupBy(week_col).agg(
        F.count_distinct("signal_group").alias("signal_groups"),
        F.count(F.lit(1)).alias("signals"),
        F.max(F.coalesce(F.col("spike_ratio"), F.lit(0.0))).alias("max_ratio"),
    )


def top_spike_weeks(spikes: DataFrame, k: int = 5, week_col: str = "week_start") -> DataFrame:
    """O2: top ``k`` weeks by (groups desc, signals desc, max ratio desc, week asc).
    ``orderBy().limit()`` plans a TakeOrderedAndProject: per-task top-k, then merge."""
    summary = spike_week_summary(spikes, week_col)
    return summary.orderBy(F.desc("signal_groups"), F.desc("signals"), F.desc("max_ratio"), F.asc(week_col)).limit(k)


def top_signals_per_week(spikes: DataFrame, weeks: DataFrame | None = None, k: int = 3,
                         week_col: str = "week_start") -> DataFrame:
    """O3: the ``k`` strongest signals of each week (ratio desc, NULL as 0, signal asc)."""
    rows = spikes if weeks is None else spikes.join(weeks.select(week_col), week_col, "left_semi")
    w = Window.partitionBy(week_col).orderBy(F.desc(F.coalesce(F.col("spike_ratio"), F.lit(0.0))), F.asc("signal"))
    return rows.withColumn("signal_rank", F.row_number().over(w)).filter(F.col("signal_rank") <= k)


def series_peaks(df: DataFrame, columns: list[str]) -> DataFrame:
    """One-row table of ``max(coalesce(x, 0))`` per column (global aggregate)."""
    return df.agg(*[F.max(F.coalesce(F.col(c), F.lit(0))).alias(f"{c}__peak") for c in columns])


def index_to_peak(df: DataFrame, columns: list[str], suffix: str = "_index") -> DataFrame:
    """``100 * coalesce(x, 0) / peak`` per series, NULL when the peak is 0.

    The peak is a global aggregate joined back as one broadcast row, so no
    window collapses the table into one partition."""
    peaks = series_peaks(df, columns)
    out = df.crossJoin(F.broadcast(peaks))
    for c in columns:
        peak = F.col(f"{c}__peak")
        out = out.withColumn(
            c + suffix,
            F.when(peak != 0, F.coalesce(F.col(c), F.lit(0)).cast("double") / peak * F.lit(100.0)),
        )
    return out.drop(*[f"{c}__peak" for c in columns])


def peak_lookup_long(spikes: DataFrame, series: DataFrame, key: str = "signal",
                     value: str = "signal_value") -> DataFrame:
    """J8 on a long series table: ``display_value`` = spike value scaled to 100 at
    its series peak (``max(coalesce(value, 0))`` per signal); a zero or missing
    peak keeps the raw value. The peak table has one row per signal."""
    peaks = series.groupBy(key).agg(F.max(F.coalesce(F.col(value), F.lit(0))).alias("series_peak"))
    joined = spikes.join(peaks, key, "left")
    p = F.col("series_peak")
    display = F.when(p.isNotNull() & (p != 0), F.col("signal_value") / p * F.lit(100.0)).otherwise(F.col("signal_value"))
    return joined.withColumn("display_value", display).drop("series_peak")


def peak_lookup(spikes: DataFrame, weekly: DataFrame, signal_to_column: dict[str, str],
                week_col: str = "week_start") -> DataFrame:
    """J8 for a wide weekly table: only the listed signals are scaled, by the peak
    of their weekly column (the dashboard does this for the interest series)."""
    long = signals_long(weekly, [SignalSpec(s, c, "true") for s, c in signal_to_column.items()], week_col)
    return peak_lookup_long(spikes, long)
