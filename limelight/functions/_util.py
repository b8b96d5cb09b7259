from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(value) -> Column:
    """Accept a column name or a Column."""
    return value if isinstance(value, Column) else F.col(value)
