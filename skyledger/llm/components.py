"""Connected components of an edge table, by alternating stars, written to the shared folder each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each vertex on the smallest of them.

    The large star takes the neighbours above the vertex, the small one those below it.
    A vertex with very many neighbours is a minimum over them, and a join whose hot side
    the adaptive planner splits.
    """

    both = edges.union(edges.select("b", "a")).toDF("u", "v") if large else edges.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        return joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) of every vertex that has an edge to another; root is the smallest of its component."""

    spark, before = edges.sparkSession, None
    now = materialize(edges.toDF("a", "b").filter("a <> b").distinct(), "edges")
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        large = _star(now, True).filter("a <> b").distinct()
        now = materialize(_star(large, False).filter("a <> b").distinct(), "edges")
    hung = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return hung.union(now.select("b", "b")).distinct()
