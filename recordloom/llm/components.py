"""Connected components of a link table, as alternating joins and aggregations in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, left: str, right: str, at: Scratch) -> DataFrame:
    """Rows (node, root) of all nodes that have a link; ``root`` is the smallest node of the component.

    Rounds go on until the links no longer change. Each round is written to shared storage, so a
    lost executor repeats one round at most; the driver sees only a count and a checksum.
    """
    state = at.save(edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").distinct(), "links")
    before = None
    while True:
        last, state = state, at.save(_small_star(_large_star(state)), "links")
        at.drop(last)
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    roots = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
