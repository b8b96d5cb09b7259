"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from limelight.functions._util import col_of

BYTES_PER_GB = 1_000_000_000
BYTES_PER_MB = 1_000_000


def safe_ratio(num, den) -> Column:
    """``num / nullif(den, 0)``; ANSI division by zero would raise."""
    return col_of(num) / F.nullif(col_of(den), F.lit(0))


def zero_default(value, zero=0) -> Column:
    """``coalesce(x, 0)``."""
    return F.coalesce(col_of(value), F.lit(zero))


def weighted_mean(value, weight) -> Column:
    """A5 aggregate: ``sum(value * weight) / nullif(sum(weight), 0)``."""
    return safe_ratio(F.sum(col_of(value) * col_of(weight)), F.sum(col_of(weight)))


def negative_indicator(tone) -> Column:
    """A2 per-row term: 1.0 below zero, 0.0 at or above, NULL tone stays NULL (DOUBLE literals)."""
    t = col_of(tone)
    return F.when(t < 0, F.lit(1.0)).when(t >= 0, F.lit(0.0))


def scale_round(value, unit: float, digits: int = 3) -> Column:
    """``round(value / unit, digits)`` (bytes -> MB/GB, fractions -> %)."""
    return F.round(col_of(value) / F.lit(float(unit)), digits)


def clip_flag(value, minimum=None, maximum=None) -> tuple[Column, Column]:
    """(clamped value, overflow flag ``up``/``down``/NULL). NULL stays NULL;
    ``greatest``/``least`` skip NULLs, so the NULL case is guarded explicitly."""
    v = col_of(value)
    clamped = v
    if maximum is not None:
        clamped = F.least(clamped, F.lit(maximum))
    if minimum is not None:
        clamped = F.greatest(clamped, F.lit(minimum))
    clamped = F.when(v.isNull() | F.isnan(v), v).otherwise(clamped)
    flag = F.lit(None).cast("string")
    if maximum is not None:
        flag = F.when(v > F.lit(maximum), F.lit("up")).otherwise(flag)
    if minimum is not None:
        flag = F.when(v < F.lit(minimum), F.lit("down")).otherwise(flag)
    flag = F.when(v.isNull() | F.isnan(v), F.lit(None).cast("string")).otherwise(flag)
    return clamped, flag
