"""Dashboard-level collections.

Only the small gold tables reach these operators (one row per match or per
week). Lists are built per group with ``collect_list`` after the groups are
formed by a shuffle, and sorted inside the list so their content is
deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limelight.functions.dates import week_start


def group_collect(df: DataFrame, key: str, fields: list[str], out: str = "rows") -> DataFrame:
    """Rows of each group as a sorted list of structs (sorted by ``fields`` order)."""
    return df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(out))


def week_to_matches(weeks: DataFrame, matches: DataFrame, date_col: str = "date", fields: list[str] | None = None,
                    week_col: str = "week_start", out: str = "matches") -> DataFrame:
    """All matches of each week as a list, empty list for weeks without one."""
    fields = fields or [c for c in matches.columns]
    per_week = group_collect(matches.withColumn(week_col, week_start(date_col)), week_col, fields, out)
    joined = weeks.join(per_week, week_col, "left")
    empty = F.array().cast(per_week.schema[out].dataType)
    return joined.withColumn(out, F.coalesce(F.col(out), empty))
