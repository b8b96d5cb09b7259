"""Set operations (U2, U3); U1 (wide -> long) lives with the spike operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def concat_tagged(frames: dict[str, DataFrame], key_col: str) -> DataFrame:
    """Tag each frame with its key (language, region, year) and append by
    column name; a lazy ``Union`` with no shuffle."""
    tagged = [df.withColumn(key_col, F.lit(key)) for key, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def append_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Column-wise append of values computed from the same row (no join)."""
    return df.withColumns(columns)
