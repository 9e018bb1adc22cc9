"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    """Each node ``u`` with the least of itself and its neighbours ``v``."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node reachable) for every node of ``edges`` (u, v).

    Each round is a stored table, so a lost executor costs one round at most. Rounds grow with
    the logarithm of the number of nodes; sums of a hub's edges are combined before the shuffle.
    """
    edges = stored(edges.where("u <> v").distinct(), "edges")
    before = None
    while True:
        now = stored(_small_star(_large_star(edges)).where("u <> v").distinct(), "stars")
        # A set of edges is compared by its size and a sum of hashes of its rows.
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if state == before:
            break
        edges, before = now, state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
