"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum (pre-aggregated before its shuffle, so a hub costs one row per task) joined back to the
edges, and every round is written to the shared folder: nothing is collected but three totals. The rounds grow with
the logarithm of the longest chain, not with its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the least node of its component) for every node other than a root; ``edges`` has a, b."""
    current = stored(spark, edges.where("a <> b").select("a", "b"), "edges")
    before = None
    while True:
        total = current.agg(F.count("a"), F.sum(F.xxhash64("a", "b") % 2**31), F.max("b")).first()
        if total == before or not total[0]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = total
        current = stored(spark, _small_star(_large_star(current).distinct()).distinct(), "edges")
