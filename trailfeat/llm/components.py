"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _stars(links: DataFrame) -> DataFrame:
    """Both star steps once over links ``(u, v)`` with ``u > v``; every node keeps a path to its smallest."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # large star: neighbours above a node are tied to the smallest of the node and its neighbours
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .where("u > v").distinct())
    # small star: a node and its neighbours below are tied to the smallest of them
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    tied = large.join(least, "u")
    return (tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` ``(u, v)``; root is the smallest node of its component.

    Loops and repeated links do no harm. Each round is written to the checkpoint
    folder; the number of rounds grows with the logarithm of the longest chain.
    Aggregates by node are combined before the shuffle, so a node with very many
    links is no hot group.
    """
    now = checkpointed(links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    stamp = None
    while True:
        # settled when a round changes nothing; a sum of hashes stands for the set
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == stamp or not found[0]:
            break
        stamp = tuple(found)
        now = checkpointed(_stars(now))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
