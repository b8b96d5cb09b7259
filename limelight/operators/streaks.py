"""Runs since the last reset, per key in order.

``value(row) = 0`` on a reset row, else the sum of ``increment`` over the rows
after the key's last reset up to and including this row.

* zero_streak (W4): reset = scoring appearance, increment = 1
* run_sum (W5): reset = scoreless appearance, increment = goals
* failure_runs (W7): reset = downloaded / missing_upstream, increment = 1 on a
  failed download and 0 on a skipped file (it neither counts nor resets)

A plain ``Window.partitionBy(key)`` sorts each key in one task; a key holding
a third of the rows would then be one task over a third of the data. The
chunked form splits every key into ordered chunks (a bucket column that is
monotone in the order, e.g. the month of the date):

1. windows over ``(key, chunk)`` give each row its value *within* the chunk; these
   rows are written once (``checkpoint``), so the input is read and shuffled once and
   rows that tie in the order keep one order for both passes;
2. a per-chunk summary (has a reset? increment after the last reset) is
   aggregated from them, combined before its shuffle;
3. a running scan over the small summary table (one row per chunk) gives the
   carry into each chunk;
4. the carry is joined back on ``(key, chunk)`` and added to the rows before
   the chunk's first reset.

Increments must be non-negative (counts, goals).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limelight.session import checkpointed


def keyed_run(df: DataFrame, keys: list[str], order_by: list[str], reset: Column, increment: Column,
              out: str, chunk: Column) -> DataFrame:
    """Chunked, skew-tolerant form (see module doc). ``chunk`` must be monotone in ``order_by``."""
    part = keys + ["_chunk"]
    w = Window.partitionBy(*part).orderBy(*order_by)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumns({
        "_chunk": chunk,
        "_reset": F.coalesce(reset, F.lit(False)),
        "_inc0": F.coalesce(increment, F.lit(0)),
    })
    rows = rows.withColumn("_inc", F.when(F.col("_reset"), F.lit(0)).otherwise(F.col("_inc0")))
    rows = rows.withColumns({
        "_cum": F.sum("_inc").over(run),
        "_seen": F.max(F.col("_reset").cast("int")).over(run),
    })
    rows = rows.withColumn("_base", F.last(F.when(F.col("_reset"), F.col("_cum")), ignorenulls=True).over(run))
    rows = rows.withColumn(
        "_local",
        F.when(F.col("_reset"), F.lit(0)).otherwise(F.col("_cum") - F.coalesce(F.col("_base"), F.lit(0))),
    )

    rows = checkpointed(rows.drop("_reset", "_inc0", "_inc"))
    # Per-chunk summary: increment after the last reset, any reset. Increments are not
    # negative, so both running columns are largest on the chunk's last row.
    summary = rows.groupBy(*part).agg(
        (F.max("_cum") - F.coalesce(F.max("_base"), F.lit(0))).alias("_tail"),
        F.max("_seen").alias("_has_reset"),
    )
    # Running scan over chunks of a key; one row per chunk, so this table is small.
    cw = Window.partitionBy(*keys).orderBy("_chunk")
    upto = cw.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = cw.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_cs", F.sum("_tail").over(upto))
    summary = summary.withColumns({
        "_prev_cs": F.col("_cs") - F.col("_tail"),
        "_reset_base": F.last(F.when(F.col("_has_reset") == 1, F.col("_cs") - F.col("_tail")), ignorenulls=True).over(before),
    })
    carry = summary.select(
        *[F.col(c).alias(f"_ck{i}") for i, c in enumerate(part)],
        (F.col("_prev_cs") - F.coalesce(F.col("_reset_base"), F.lit(0))).alias("_carry"),
    )
    # Null-safe equality: a NULL key (or a NULL chunk from a NULL order value) is a
    # group of its own in the windows, so it must find its carry too.
    cond = [rows[c].eqNullSafe(carry[f"_ck{i}"]) for i, c in enumerate(part)]
    joined = rows.join(carry, cond, "left").drop(*[f"_ck{i}" for i in range(len(part))])
    value = F.when(F.col("_seen") == 1, F.col("_local")).otherwise(F.col("_local") + F.coalesce(F.col("_carry"), F.lit(0)))
    return joined.withColumn(out, value).drop("_chunk", "_cum", "_seen", "_base", "_local", "_carry")


def zero_streak(df: DataFrame, keys: list[str], order_by: list[str], hit: Column, chunk: Column,
                out: str = "zero_streak") -> DataFrame:
    """Length of the current run of non-hits; 0 on a hit."""
    return keyed_run(df, keys, order_by, hit, F.lit(1), out, chunk)


def run_sum(df: DataFrame, keys: list[str], order_by: list[str], amount: Column, chunk: Column,
            out: str = "run_sum") -> DataFrame:
    """Amount accumulated during the current run; an amount of 0 ends it, a NULL adds nothing."""
    return keyed_run(df, keys, order_by, amount == 0, amount, out, chunk)


def failure_runs(df: DataFrame, keys: list[str], order_by: list[str], chunk: Column, status: str = "download_status",
                 limit: int = 3, out: str = "failure_run") -> DataFrame:
    """Consecutive failed downloads per worker, in order; ``downloaded`` and
    ``missing_upstream`` reset, ``skipped`` neither counts nor resets. Every row
    gets its current run length and ``breach`` = run >= ``limit``."""
    s = F.col(status)
    reset = s.isin("downloaded", "missing_upstream")
    increment = F.when(s == "download_failed", F.lit(1)).otherwise(F.lit(0))
    return keyed_run(df, keys, order_by, reset, increment, out, chunk).withColumn("breach", F.col(out) >= limit)


def numbered(df: DataFrame, key: str, order: str, chunk: Column, out: str = "_place") -> DataFrame:
    """Adds the place (from 1) of every row in its key's order by the same chunked scan:
    row numbers within ``(key, chunk)`` plus the sizes of the key's earlier chunks."""
    within = Window.partitionBy(key, "_chunk").orderBy(order)
    rows = checkpointed(df.withColumn("_chunk", chunk).withColumn(out, F.row_number().over(within).cast("bigint")))
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy(key, "_chunk").agg(F.max(out).alias("_n")).select(
        F.col(key).alias("_ck0"), F.col("_chunk").alias("_ck1"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier"))
    same = rows[key].eqNullSafe(carry["_ck0"]) & rows["_chunk"].eqNullSafe(carry["_ck1"])
    return rows.join(carry, same).withColumn(out, F.col(out) + F.col("_earlier")).drop("_ck0", "_ck1", "_chunk", "_earlier")
