"""Connected components of a table of links, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthbook.llm.common import checkpointed, let_go


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Point the neighbours of every node at its smallest neighbour: the larger neighbours, or the smaller ones.

    Minima are combined before their shuffle, and a node with many neighbours is a skewed key of a plain join.
    """
    rows = _both_ways(links) if larger else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = rows.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("least", "a"))
    joined = rows.join(least, "a")
    if larger:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    own = least.select("a", F.col("least").alias("b"))
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(own).where("a <> b").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root for every node in `links` (columns a, b; long): root is the smallest node reachable.

    Every round is written to the shared folder, and what the one before it left behind goes. Rounds grow with the
    logarithm of the longest path.
    """
    links = checkpointed(links.select("a", "b").where("a <> b").distinct())
    before = None
    for _ in range(most_rounds):
        links = checkpointed(_stars(_stars(links, True), False))
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            roots = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
            own = links.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
            return roots.union(own)
        before = state
        let_go(links.sparkSession)
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
