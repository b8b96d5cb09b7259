"""Keep the first row per key under a total order.

Written as an aggregation (``min`` of a struct whose leading fields are the
order keys) rather than ``row_number()`` over a window: the aggregate is
combined map-side before the shuffle, so a key that holds a third of all rows
is reduced to one candidate per map task instead of landing whole on one
reducer. ``dropDuplicates`` is not used because its choice of row is undefined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

ARTICLE_ORDER = ["gkg_datetime", "stream", "GKGRECORDID", "DocumentIdentifier"]


def _order_struct(order_by: list[str], nulls_last: bool = True):
    fields = []
    for i, c in enumerate(order_by):
        if nulls_last:
            fields.append(F.col(c).isNull().alias(f"_o{i}n"))
        fields.append(F.col(c).alias(f"_o{i}"))
    return fields


def dedup_keep_first(df: DataFrame, key: str, order_by: list[str], nulls_last: bool = True) -> DataFrame:
    """One row per non-NULL ``key``: the smallest under ``order_by`` (ascending,
    NULLs last like pandas). Remaining ties are broken by the whole row, so the
    result is deterministic. Rows with a NULL key are not merged with each other:
    each is a group of its own in the same aggregate."""
    cols = df.columns
    packed = F.struct(*_order_struct(order_by, nulls_last), F.struct(*[F.col(c) for c in cols]).alias("_row"))
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return (
        df.select(F.col(key), own.alias("_own"), packed.alias("_packed"))
        .groupBy(key, "_own")
        .agg(F.min("_packed").alias("_m"))
        .select(*[F.col("_m._row")[c].alias(c) for c in cols])
    )


def dedup_with_metrics(df: DataFrame, key: str, order_by: list[str]) -> tuple[DataFrame, Observation, Observation]:
    """Deduplicate and observe candidate and retained row counts in the same pass
    as the sink's action (no extra job). Read ``obs.get`` after the action."""
    before = Observation("dedup_candidates")
    after = Observation("dedup_retained")
    observed_in = df.observe(before, F.count(F.lit(1)).alias("candidate_rows"))
    out = dedup_keep_first(observed_in, key, order_by).observe(after, F.count(F.lit(1)).alias("retained_rows"))
    return out, before, after


def dedup_counts(df: DataFrame, key: str) -> DataFrame:
    """A25 as a query: candidate rows, removed duplicates, retained rows, in one
    aggregate (NULL-key rows are retained individually)."""
    return df.agg(
        F.count(F.lit(1)).alias("candidate_rows"),
        (F.count_distinct(F.col(key)) + F.count_if(F.col(key).isNull())).alias("retained_rows"),
    ).select(
        "candidate_rows",
        (F.col("candidate_rows") - F.col("retained_rows")).alias("removed_rows"),
        "retained_rows",
    )
