"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stressframe.session import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    n = _both_ways(edges)
    low = n.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return n.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    n = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = n.groupBy("u").agg(F.min("v").alias("m"))
    near = n.join(low, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return near.unionAll(low.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(links: DataFrame, parts: int | None = None, max_rounds: int = 64) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the smallest node it reaches.

    ``parts``: into how many files a round's links go (few for a small graph).
    Only grouped minima and joins on nodes; a round's links are written to the
    checkpoint folder.  The number of rounds grows with the logarithm of the
    longest path; two counts a round reach the driver."""
    def kept(df: DataFrame) -> DataFrame:
        return cut_lineage(df.distinct().coalesce(parts) if parts else df.distinct())

    edges = kept(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    before = None
    for _ in range(max_rounds):
        edges = kept(_small_star(_large_star(edges)).where("a <> b"))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
