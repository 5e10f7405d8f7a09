"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Workspace


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    near = down.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(work: Workspace, edges: DataFrame) -> DataFrame:
    """From edges ``(a, b)`` of longs to ``(node, root)``, root the smallest node reachable; nodes without
    edges are left out.

    Every step aggregates a minimum per node before it joins, so that a node of very many edges is summed up
    on the map side, and AQE can split its join. The number of rounds grows with the logarithm of the longest
    path. Each round is written to the shared folder.
    """
    now = work.put(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _state(now)
    while True:
        new = work.put(_small_star(_large_star(now)))
        work.drop(now)
        now, last = new, seen
        if (seen := _state(now)) == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
