"""Connected components of an undirected graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limelight.llm import common as C


def _both(df: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Two pairs (u, v) of every row."""
    pair = lambda p: F.struct(F.col(p[0]).alias("u"), F.col(p[1]).alias("v"))
    return df.select(F.explode(F.array(pair(first), pair(second))).alias("x")).select("x.u", "x.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point at its smallest neighbour (or itself)."""
    both = _both(edges, ("u", "v"), ("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point at the smallest of them. Edges come as (larger, smaller)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return _both(edges.join(least, "u"), ("v", "m"), ("u", "m")).where("u != v").distinct()


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge; a component is named by its smallest node."""
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") != F.col("v")).distinct()
    now = C.cut(now)
    seen = _mark(now)
    while True:
        now = C.cut(_small_star(_large_star(_small_star(_large_star(now)))))  # two steps a job: fewer jobs on small graphs
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    # every edge is now (node, smallest node of its component)
    return _both(now, ("u", "v"), ("v", "v")).select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()
