"""Connected components by alternating large-star and small-star steps.

Every step is a pre-aggregated minimum per node and a join back to the edges,
so a node with a third of all edges is no hot spot; each step's edges are
written to the shared folder, which cuts lineage and survives lost executors;
the step before is deleted then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v); both directions for the large star, larger to smaller for the small one."""
    big, small = F.greatest("u", "v"), F.least("u", "v")
    down = edges.where("u <> v").select(big.alias("u"), small.alias("v"))
    e = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else down
    low = e.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    both = e.join(low, "u")
    moved = both.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else both.select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = moved if large else moved.unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """``(node, component)`` for every node of the undirected edges ``(u, v)``; component is the smallest node."""
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), tag)
    state = None
    while True:
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
        if not new[0]:
            break
        large = written(_star(now, True), tag)
        discard(now)
        now = written(_star(large, False), tag)
        discard(large)
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
