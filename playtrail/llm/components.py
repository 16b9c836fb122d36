"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to (node, root): the smallest node each node reaches. Roots and nodes without edges do not appear.

    Each step maps every node's neighbours to the smallest of them; the number of steps grows with the logarithm of the
    longest chain. All steps are joins and minima; tables between steps are written to the shared folder.
    """
    state = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = state.union(state.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.join(least, "a").where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = (small.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).distinct())
        state = written(small, "edges")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return state.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
