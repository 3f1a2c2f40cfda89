"""Connected components of a graph given as edges, by stars that grow and shrink in turn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _lowest(pairs: DataFrame) -> DataFrame:
    """Each ``a`` with the lowest of itself and its ``b``."""
    return pairs.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (its lowest node), for every node that has an edge.

    In each round the larger neighbours of a node are linked to its lowest neighbour, then the smaller ones. Rounds grow with
    the logarithm of the longest chain. Minima are aggregated before the shuffle, lists of neighbours are never made, and
    each round is written to the shared folder, so a lost executor costs one round at most.
    """
    now = stage(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b").distinct(), "edges")
    seen = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.where("b > a").join(_lowest(both), "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        large = stage(large.where("a != b").distinct(), "edges")
        low = _lowest(large)
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).union(low.select("a", "_m"))
        now = stage(small.where("a != b").distinct(), "edges")
        is_now = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if is_now == seen:
            break
        seen = is_now
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
