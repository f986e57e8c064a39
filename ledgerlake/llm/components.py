"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum (combined before the shuffle) and a join; edges never
leave the executors. Each round is stored in the shared folder and the one before it removed.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node reachable.

    Edges may repeat, run either way or be loops (a node with only loops is left out).
    Nodes may be of any ordered type. An empty table gives an empty table.
    """
    spark = edges.sparkSession
    before = Scratch(spark)
    e = before.stored(edges.where(F.col(a) != F.col(b))
                      .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    seen = _state(e)
    while seen[0]:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, F.col("u") == F.col("k"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = (large.join(low, F.col("u") == F.col("k")).where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        after = Scratch(spark)
        e = after.stored(small.union(low.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct())
        before.remove()
        before, now = after, _state(e)
        if now == seen:
            break
        seen = now
    roots = e.select("v").distinct()
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(roots.select(F.col("v").alias("node"), F.col("v").alias("root"))))


def _state(e: DataFrame) -> tuple:
    """Row count and an order-free digest: equal when a round changed nothing."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(e.agg(F.count(F.lit(1)), F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)"))).first())
