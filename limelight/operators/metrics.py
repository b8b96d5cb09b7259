"""Aggregations.

Every aggregate here is a single ``groupBy().agg()`` with conditional
aggregates instead of one scan per measure: Spark plans one partial
(map-side) + final HashAggregate, so the shuffle carries one row per group
and map task, whatever the skew of the grouping key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limelight.functions.dates import week_start as week_start_of
from limelight.functions.numeric import negative_indicator, weighted_mean


@dataclass(frozen=True)
class Segment:
    """A named subset of articles; ``with_tone`` adds the mean tone and negative share."""

    name: str
    condition: str
    with_tone: bool = True


# Fixed values that must equal the reference for equal results.
ARTICLE_SEGMENTS = [
    Segment("english", "stream = 'regular'"),
    Segment("english_high_salience", "stream = 'regular' and salience_score >= 0.70"),
    Segment("translated", "stream = 'translation'"),
    Segment("translated_french", "stream = 'translation' and source_language = 'fra'"),
    Segment("translated_spanish", "stream = 'translation' and source_language = 'spa'"),
    Segment("translated_other", "stream = 'translation' and source_language not in ('fra', 'spa')", with_tone=False),
]


def segment_measures(segments=ARTICLE_SEGMENTS, tone: str = "tone") -> list[Column]:
    """A1/A2: ``count(*) FILTER``, ``avg(tone) FILTER`` and the negative share per segment."""
    out = []
    for seg in segments:
        cond = F.expr(seg.condition)
        out.append(F.count_if(F.coalesce(cond, F.lit(False))).alias(f"{seg.name}_coverage"))
        if seg.with_tone:
            out.append(F.avg(F.when(cond, F.col(tone))).alias(f"{seg.name}_avg_tone"))
            out.append(F.avg(F.when(cond, negative_indicator(tone))).alias(f"{seg.name}_negative_share"))
    return out


def daily_filtered_metrics(articles: DataFrame, date_col: str = "gkg_date", segments=ARTICLE_SEGMENTS,
                           tone: str = "tone", out_date: str = "date") -> DataFrame:
    """A1: per-day coverage and tone measures for every segment, ordered by day (O1)."""
    return (
        articles.groupBy(F.col(date_col).alias(out_date))
        .agg(*segment_measures(segments, tone))
    )


def segment_weights(segments=ARTICLE_SEGMENTS) -> dict[str, str]:
    """mean column -> coverage column, for A5."""
    weights = {}
    for seg in segments:
        if seg.with_tone:
            weights[f"{seg.name}_avg_tone"] = f"{seg.name}_coverage"
            weights[f"{seg.name}_negative_share"] = f"{seg.name}_coverage"
    return weights


def conditional_max_pivot(df: DataFrame, keys: list[str], pivot_col: str, value_col: str,
                          mapping: dict[str, str], agg=F.max) -> DataFrame:
    """A3: long -> wide with ``max(value) FILTER (WHERE pivot = v)`` per listed value.

    The value list is explicit (no extra job to discover it, unlike ``pivot()``
    without values)."""
    measures = [agg(F.when(F.col(pivot_col) == F.lit(v), F.col(value_col))).alias(name) for v, name in mapping.items()]
    return df.groupBy(*keys).agg(*measures)


def weekly_rollup(daily: DataFrame, columns: list[str], weights: dict[str, str],
                  availability: dict[str, str] | None = None, date_col: str = "date",
                  week_col: str = "week_start") -> DataFrame:
    """One row per Sunday week.

    ``columns`` in output order; a column in ``weights`` becomes the weighted
    mean ``sum(x*w)/nullif(sum(w),0)`` with its weight column, every other one
    a ``sum``. ``days_in_period`` counts days; ``availability`` maps output
    names to columns whose non-NULL days are counted (feed availability)."""
    measures = [F.count(F.lit(1)).alias("days_in_period")]
    for name, col in (availability or {}).items():
        measures.append(F.count(F.col(col)).alias(name))
    for c in columns:
        if c in weights:
            measures.append(weighted_mean(c, weights[c]).alias(c))
        else:
            measures.append(F.sum(F.col(c)).alias(c))
    return daily.groupBy(week_start_of(date_col).alias(week_col)).agg(*measures)


def period_bounds(df: DataFrame, date_col: str = "date") -> DataFrame:
    """One row ``(start_date, end_date)``."""
    return df.agg(F.min(date_col).alias("start_date"), F.max(date_col).alias("end_date"))


def kpi_totals(weekly: DataFrame, article_cols: list[str], view_cols: list[str], goals_col: str = "football_goals",
               week_col: str = "week_start", days_col: str = "days_in_period") -> DataFrame:
    """Totals and the true period covered by partial edge weeks. One global
    aggregate (partial per task, one row to the final step): no single-partition window."""
    def total(cols):
        return F.sum(sum((F.coalesce(F.col(c), F.lit(0)) for c in cols), F.lit(0)))

    first = F.min_by(F.struct(F.col(week_col).alias("w"), F.col(days_col).alias("d")), F.col(week_col))
    last = F.max_by(F.struct(F.col(week_col).alias("w"), F.col(days_col).alias("d")), F.col(week_col))
    agg = weekly.agg(
        total(article_cols).cast("bigint").alias("articles"),
        total(view_cols).cast("bigint").alias("views"),
        total([goals_col]).cast("bigint").alias("goals"),
        F.count(F.lit(1)).alias("weeks"),
        first.alias("_first"),
        last.alias("_last"),
    )
    return agg.select(
        "articles", "views", "goals", "weeks",
        F.date_add(F.col("_first.w"), F.when(F.col("_first.d") == 7, F.lit(0)).otherwise(7 - F.col("_first.d")).cast("int")).alias("period_start"),
        F.date_add(F.col("_last.w"), (F.col("_last.d") - 1).cast("int")).alias("period_end"),
    )


def overall_split(weekly: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Coverage-weighted negative / non-negative totals over the period per
    named (coverage, negative share) pair. Weeks with zero or missing coverage
    are skipped; a missing share counts as 0 like the dashboard's ``Number(null)``."""
    measures = []
    for name, (cov, share) in pairs.items():
        c = F.coalesce(F.col(cov).cast("double"), F.lit(0.0))
        s = F.coalesce(F.col(share), F.lit(0.0))
        valid = (c != 0) & ~F.isnan(c) & ~F.isnan(s)
        measures.append(F.coalesce(F.sum(F.when(valid, c * s)), F.lit(0.0)).alias(f"{name}__neg"))
        measures.append(F.coalesce(F.sum(F.when(valid, c * (F.lit(1.0) - s))), F.lit(0.0)).alias(f"{name}__non"))
    wide = weekly.agg(*measures)
    stack = ", ".join(f"'{n}', `{n}__neg`, `{n}__non`" for n in pairs)
    long = wide.selectExpr(f"stack({len(pairs)}, {stack}) as (split, negative, non_negative)")
    total = F.col("negative") + F.col("non_negative")
    return long.withColumn("negative_share", F.when(total != 0, F.col("negative") / total).otherwise(F.lit(0.0)))


def scoring_split(matches: DataFrame, goals: str = "goals", minutes: str = "minutes", threshold: int = 45) -> DataFrame:
    """Scoring vs scoreless matches for all, >= threshold and < threshold
    minutes, in one pass; the share is 0 for an empty subset."""
    m = F.coalesce(F.col(minutes), F.lit(0))
    scored = F.coalesce(F.col(goals) > 0, F.lit(False))
    subsets = {"all": F.lit(True), f"min_{threshold}_plus": m >= threshold, f"under_{threshold}": m < threshold}
    measures = []
    for name, cond in subsets.items():
        measures.append(F.count_if(cond).alias(f"{name}__n"))
        measures.append(F.count_if(cond & scored).alias(f"{name}__s"))
    wide = matches.agg(*measures)
    stack = ", ".join(f"'{n}', `{n}__n`, `{n}__s`" for n in subsets)
    long = wide.selectExpr(f"stack({len(subsets)}, {stack}) as (subset, matches, scoring_matches)")
    return long.select(
        "subset", "matches", "scoring_matches",
        (F.col("matches") - F.col("scoring_matches")).alias("scoreless_matches"),
        F.when(F.col("matches") > 0, F.col("scoring_matches") / F.col("matches")).otherwise(F.lit(0.0)).alias("scoring_share"),
    )


def collector_totals(df: DataFrame, key: str, value: str | None = None) -> DataFrame:
    """Rows and value total per key."""
    measures = [F.count(F.lit(1)).alias("rows")]
    if value:
        measures.append(F.sum(value).alias(f"total_{value}"))
    return df.groupBy(key).agg(*measures)
