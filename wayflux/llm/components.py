"""Connected components of a graph that no single machine has to hold: alternating large-star and
small-star rounds (Kiveris et al. 2014), the distributed form of union-find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come with u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (least.select("u", F.col("m").alias("v")).unionByName(moved.where("u <> v")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: for each node of an edge (u, v) the least node it is connected to.

    Loops, repeated and reversed edges change nothing; without edges the result is empty.  Only
    a count and a checksum of the edges reach the driver.
    """
    now = stored(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    was = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == was or state[0] == 0:
            break
        was = state
        now = stored(_small_star(_large_star(now)), "links")
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
