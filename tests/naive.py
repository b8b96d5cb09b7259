"""Single-window forms of the streak operators, to hold the chunked ones against."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keyed_run_naive(df: DataFrame, keys: list[str], order_by: list[str], reset: Column, increment: Column,
                    out: str) -> DataFrame:
    """Single-window form: correct, but each key is one task. For small inputs and tests."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tmp = df.withColumns({"_reset": F.coalesce(reset, F.lit(False)), "_inc": F.coalesce(increment, F.lit(0))})
    tmp = tmp.withColumn("_inc", F.when(F.col("_reset"), F.lit(0)).otherwise(F.col("_inc")))
    tmp = tmp.withColumn("_cum", F.sum("_inc").over(run))
    tmp = tmp.withColumn("_base", F.last(F.when(F.col("_reset"), F.col("_cum")), ignorenulls=True).over(run))
    value = F.when(F.col("_reset"), F.lit(0)).otherwise(F.col("_cum") - F.coalesce(F.col("_base"), F.lit(0)))
    return tmp.withColumn(out, value).drop("_reset", "_inc", "_cum", "_base")
