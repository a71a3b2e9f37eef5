"""Connected components by alternating large-star and small-star steps, each a join and a grouped minimum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import cut, forget


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest node of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links the smaller neighbours of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    moved = down.join(low, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(low.select("u", F.col("low").alias("v")))


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """``node, component`` (its smallest node) for every node of ``edges(u, v)``; loops and repeats do no harm.

    Each round is written to the shared folder and the one before it deleted.  The end is reached when a round changes
    no link, after a number of rounds that grows with the logarithm of the longest path.
    """
    now = cut(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    stamp = None
    for _ in range(most):
        after = cut(_small_star(_large_star(now)).distinct(), "edges")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        forget(now)
        now = after
        if mark == stamp or not mark[0]:
            break
        stamp = mark
    else:
        raise RuntimeError("components did not settle")
    found = cut(now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct()), "components")
    forget(now)
    return found
