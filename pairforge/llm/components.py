"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) -> (node, root): the least node that is reachable, for every node on an edge.

    Each round links every node to the least neighbour it knows (large star: all
    larger neighbours; small star: the smaller ones); the rounds end when nothing
    changes.  Sums over nodes are partial before each shuffle, so a node with many
    edges isn't gathered; every round is written to the shared folder."""
    e = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    known = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        e = stage(small.select("a", F.col("m").alias("b"))
                  .unionByName(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
                  .filter("a <> b").distinct(), "cc")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == known:
            break
        known = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
