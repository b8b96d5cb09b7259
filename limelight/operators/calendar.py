"""Calendar joins.

The spine is one row per day of the requested period (tens of thousands of
rows for a century), so it is generated on the cluster with ``sequence`` and
joined with left outer joins; facts are aggregated to one row per day before
the join, so both sides are small and the join never fans out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limelight.operators.quality import check_unique_combination


def spine_left_joins(spine: DataFrame, facts: list[DataFrame], on: str = "date",
                     zero_fill: dict[str, object] | None = None) -> DataFrame:
    """J1 + F23: spine LEFT JOIN each fact table ``USING (on)``; ``zero_fill``
    columns get ``coalesce(x, 0)``, all others keep NULL for missing days."""
    out = spine
    for f in facts:
        out = out.join(f, on, "left")
    if zero_fill:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in zero_fill.items()})
    return out


def densify(spine: DataFrame, facts: DataFrame, on: list[str], fill: dict[str, object]) -> DataFrame:
    """Spine LEFT JOIN facts, NULL -> fill value. Uniqueness of ``on`` in the
    facts is what keeps this one-to-one; see ``quality.check_one_to_one`` (Q8)."""
    return spine.join(facts, on, "left").fillna(fill)
