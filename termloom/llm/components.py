"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a min per node and a join, both keyed by node, so no component is ever gathered in one place; AQE splits the
join of a hub. The edges of each round are settled in the shared folder. Rounds end when no edge changes; their number
grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.runtime import release, settle

MAX_ROUNDS = 60


def _large_star(e: DataFrame) -> DataFrame:
    """Every node's larger neighbours, and nothing else, hang on the node's least neighbour (itself included)."""
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Edges run from larger a to smaller b; every node and its smaller neighbours hang on the least of those."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    return (
        e.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        .union(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the least node reachable) for every node of the edges (a, b), both longs; roots included."""
    e = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    digest = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    last = digest(e)
    for _ in range(MAX_ROUNDS if last[0] else 0):
        before, e = e, settle(_small_star(_large_star(e)), "edges")
        release(before)
        now = digest(e)
        if now == last:
            break
        last = now
    else:
        if last[0]:
            raise RuntimeError("components did not settle")
    leaves = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
