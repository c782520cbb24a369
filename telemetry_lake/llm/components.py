"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.common import stage


def _both(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    near = _both(links)
    least = near.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    moved = near.where("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them. a > b holds."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node it can reach.

    Each step is a grouped minimum and a join; its result is a written table, so neither
    the lineage nor the driver grows. The steps end when a round changes nothing, after
    about the logarithm of the longest chain.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    links = stage(links.where("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "links")
    before = _state(links)
    while before[0]:
        links = stage(_small_star(_large_star(links)), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b"), F.col("b")).distinct()
    )
