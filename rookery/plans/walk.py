"""Breadth-first reach over links, one join for each step."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="rookery-walk-"))


def reach(edges: DataFrame, roots: DataFrame, most: int = 10_000) -> DataFrame:
    """``node, depth`` of all nodes that ``edges(src, dst)`` lead to from ``roots(node)``, by the shortest way.

    Each step writes the nodes that it meets first to the checkpoint folder, and no others; only whether there are any is
    told to the driver.  A walk that is not at its end after ``most`` steps is an error.
    """
    _checkpoints(edges.sparkSession)
    frontier = roots.select("node").distinct().withColumn("depth", F.lit(0)).checkpoint()
    seen = frontier
    for depth in range(1, most + 1):
        step = frontier.join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        frontier = step.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth)).checkpoint()
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)
    raise RuntimeError(f"the walk is not at its end after {most} steps")
