"""Connected components of an edge table by alternating large and small stars.

Every round is two joins of the edges with each node's smallest neighbour; edges and minima
are stored before they are joined, so a node with very many edges is a skewed partition that
AQE splits. Nothing is collected but a count and a checksum of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrosense.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (hi, lo; hi > lo) moved to each node's smallest neighbour."""
    up = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    down = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    seen = up.unionAll(down) if large else down
    least = stored(seen.groupBy("u").agg(F.min("v").alias("m"))
                   .select("u", F.least("u", "m").alias("m")), "component-minima")
    moved = (up if large else down).join(least, "u")
    pairs = moved.select(F.col("v"), F.col("m"))
    if not large:
        pairs = pairs.unionAll(least.select(F.col("u").alias("v"), "m"))
    return stored(pairs.where("v <> m").select(F.greatest("v", "m").alias("hi"),
                                               F.least("v", "m").alias("lo")).distinct(),
                  "component-edges")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``edges`` (x, y)."""
    e = stored(edges.where("x <> y").select(F.greatest("x", "y").alias("hi"),
                                            F.least("x", "y").alias("lo")).distinct(),
               "component-edges")
    state = None
    while True:
        e = _stars(_stars(e, large=True), large=False)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    found = e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return found.unionAll(e.select(F.col("lo").alias("node"), F.col("lo").alias("component"))
                          .distinct())
