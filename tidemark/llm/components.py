"""Connected components of a link table, with Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b); root is the least node.

    Rounds of large-star and small-star: every node points its larger
    neighbours, then its smaller ones, at the least neighbour. Each round is an
    aggregate and a join on the node (AQE splits a node that many rows point
    to), and ends in a ``checkpoint`` in the shared folder. The number of
    rounds grows with the logarithm of the longest chain; the driver sees three
    sums a round.
    """
    state = cut_lineage(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        both = state.union(state.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("a"),
                                                             F.col("m").alias("b")).distinct())
        # a node may now hold several smaller neighbours: point them at the least
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = large.join(least, "a")
        small = (pairs.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        state = cut_lineage(small)
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").bitwiseAND(0xFFFFFF)),
                        F.sum(F.xxhash64("b", "a").bitwiseAND(0xFFFFFF))).first()
        if now == seen or not now[0]:
            break
        seen = now
    return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
