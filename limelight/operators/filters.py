"""Projections, filters and predicates.

All are narrow transformations: Catalyst pushes simple comparisons into the
Parquet scan (``PushedFilters``) and prunes unread columns.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limelight.functions._util import col_of
from limelight.functions.dates import parse_feed_timestamp, to_day
from limelight.functions.text import strict_int


def any_column_contains(columns: list[str], token: str) -> Column:
    """Case-insensitive substring test OR-reduced over ``columns``."""
    pattern = f"%{token}%"
    return reduce(or_, [F.coalesce(F.col(c).ilike(pattern), F.lit(False)) for c in columns])


def filter_candidates(df: DataFrame, columns: list[str], token: str) -> DataFrame:
    return df.filter(any_column_contains(columns, token))


def parse_timestamps(df: DataFrame, text_col: str = "DATE", ts_col: str = "gkg_datetime",
                     date_col: str = "gkg_date") -> DataFrame:
    """P2 helper: parsed timestamp and its UTC day next to the raw text."""
    return df.withColumn(ts_col, parse_feed_timestamp(text_col)).withColumn(date_col, to_day(ts_col))


def split_bad_timestamp(df: DataFrame, ts_col: str = "gkg_datetime") -> tuple[DataFrame, DataFrame]:
    """(rows with a parsed timestamp, rejected rows)."""
    return df.filter(F.col(ts_col).isNotNull()), df.filter(F.col(ts_col).isNull())


def date_between(df: DataFrame, column: str, start, end) -> DataFrame:
    """Closed date range."""
    return df.filter(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def played_only(df: DataFrame, minutes_col: str = "total_time") -> DataFrame:
    """P5."""
    return df.filter(F.col(minutes_col).isNotNull())


def within_period(df: DataFrame, column: str, bounds: DataFrame,
                  start_col: str = "start_date", end_col: str = "end_date") -> DataFrame:
    """Keep rows whose ``column`` lies within ``bounds``.

    The bounds go through a global aggregate here, so what is broadcast is one row
    whatever the caller passes; the nested-loop join against one row is a filter."""
    one_row = bounds.agg(F.min(start_col).alias(start_col), F.max(end_col).alias(end_col))
    return (
        df.crossJoin(F.broadcast(one_row))
        .filter(F.col(column).between(F.col(start_col), F.col(end_col)))
        .drop(start_col, end_col)
    )


def complete_period_gate(value, *conditions: Column) -> Column:
    """Value as DOUBLE only when every condition holds, else NULL."""
    cond = reduce(lambda a, b: a & b, conditions)
    return F.when(cond, col_of(value).cast("double"))


def spike_predicate(min_observations: int = 12) -> Column:
    """Enough baseline and strictly above the threshold."""
    return (F.col("baseline_observations") >= min_observations) & (F.col("signal_value") > F.col("spike_threshold"))


def not_in_list(column, values: list) -> Column:
    """P9 (SQL ``NOT IN``: NULL stays unknown, so it is not selected)."""
    return ~col_of(column).isin(values)


def exclude_category(df: DataFrame, column: str, value) -> DataFrame:
    """P10: drop one category but keep NULLs (pandas ``!=`` semantics)."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def threshold_split(df: DataFrame, column: str, threshold) -> tuple[DataFrame, DataFrame]:
    """(rows >= threshold, rows < threshold); NULL compares as 0, as in ``scoring_split``."""
    value = F.coalesce(F.col(column), F.lit(0))
    return df.filter(value >= threshold), df.filter(value < threshold)


def signal_in_lanes(df: DataFrame, lanes: list[str], signal_col: str = "signal",
                    lane_col: str = "lane") -> DataFrame:
    """Keep rows whose signal is in a known list and attach its position.

    The lane list is a literal of bounded size, so this is a map lookup in the
    projection (no join at all)."""
    lookup = F.create_map(*[x for i, s in enumerate(lanes) for x in (F.lit(s), F.lit(i))])
    return df.withColumn(lane_col, F.try_element_at(lookup, F.col(signal_col))).filter(F.col(lane_col).isNotNull())


def marker_flags(df: DataFrame, goals: str = "goals", yellow: str = "yellow_cards", red: str = "red_cards") -> DataFrame:
    """Per-match markers: scored, played-no-goal, cards (NULL when absent)."""
    g = F.col(goals)
    return df.withColumns({
        "scored_marker": F.when(g > 0, F.lit(1)),
        "no_goal_marker": F.when(g == 0, F.lit(1)),
        "yellow_marker": F.when(F.coalesce(F.col(yellow), F.lit(0)) != 0, F.col(yellow)),
        "red_marker": F.when(F.coalesce(F.col(red), F.lit(0)) != 0, F.col(red)),
    })


def goals_in_played_weeks(appearances="football_appearances", goals="football_goals") -> Column:
    """Weekly goals only for weeks with an appearance, else NULL."""
    return F.when(F.col(appearances) > 0, F.coalesce(F.col(goals), F.lit(0)))


def rename_normalize(df: DataFrame, renames: dict[str, str], int_columns: list[str],
                     order: list[str] | None = None) -> DataFrame:
    """Rename, cast text to nullable integers, reorder."""
    out = df.withColumnsRenamed(renames)
    out = out.withColumns({c: strict_int(F.col(c).cast("string")) for c in int_columns})
    return out.select(*order) if order else out
