"""Connected components of a large edge list by alternating star rounds.

Each round points every node of a neighbourhood at its smallest member, once from the
larger side (large star) and once from the smaller (small star); the edges shrink to one
star for each component in a logarithmic number of rounds. A round groups with map-side
minima and joins on the node. The minima are written before the join: both its sides are
then plain tables with exchanges of their own, so a node with very many edges is split. The
edges are written to the shared folder between rounds too, so a lost executor repeats one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialise(both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m")), "least")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = materialise(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 1_000_003)).first())


def star_components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of ``edges`` (a, b:
    long) that is not a root itself."""
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = materialise(_small_star(materialise(_large_star(edges), "stars")), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
