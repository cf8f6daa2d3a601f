"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared_store import Workspace


def large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to the smallest node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(node, component) of every node with an edge; a component is named by its smallest node.

    ``edges`` has long columns a and b. Each round is two joins on aggregated minima and is written
    down; rounds grow with the logarithm of the longest chain.
    """
    state = lambda df: tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())
    now = work.save(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}0")
    before, k = state(now), 0
    while before[0]:
        k += 1
        now = work.save(small_star(large_star(now)), f"{name}{k}")
        work.drop(f"{name}{k - 1}")
        after = state(now)
        if after == before:
            break
        before = after
    pairs = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.unionByName(roots)
