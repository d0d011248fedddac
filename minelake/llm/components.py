"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minelake.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    near = edges.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return near.union(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b); component = smallest id.

    Rows with equal or null ends name no edge; repeated edges count once; no edges, no rows.

    Each round contracts stars with partial aggregates and joins, and is written
    to the shared folder; rounds are logarithmic in the longest chain. No edge
    list or component reaches the driver: only a count and a checksum do.
    """
    def state(e: DataFrame):
        # two 64-bit checksums: unequal edge sets agree by chance in 2**-128
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(7)))).first())

    norm = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = written(norm, "edges")
    now = state(edges)
    while True:
        edges = written(_small_star(_large_star(edges)), "stars")
        then, now = now, state(edges)
        if then == now:
            break
    nodes = edges.select(F.col("b").alias("id"), F.col("a").alias("component"))
    return nodes.union(edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())
