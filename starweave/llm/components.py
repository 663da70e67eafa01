"""Connected components of a sparse edge list by alternating stars.

Each round is two joins against the smallest neighbour of a node; no edge
list, component or label ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import persist

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to its smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("m").alias("u"), "v").where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest."""
    down = edges.select(F.col("v").alias("node"), F.col("u").alias("w"))
    least = down.groupBy("node").agg(F.min("w").alias("m"))
    moved = down.join(least, "node").where("w <> m").select(F.col("m").alias("u"), F.col("w").alias("v"))
    return moved.union(least.select(F.col("m").alias("u"), F.col("node").alias("v"))).distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest id reachable, for every node of an edge
    (u, v); nodes without an edge do not occur."""
    e = edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    e = persist(spark, e, "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        state = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            return e.select(F.col("v").alias("node"), F.col("u").alias("root"))
        seen = state
        e = persist(spark, _small_star(persist(spark, _large_star(e), "edges")), "edges")
    raise RuntimeError("components did not converge")
