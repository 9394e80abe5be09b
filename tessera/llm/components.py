"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of (u, v), both long.

    Each round joins and pre-aggregates edges by node, so a hub is no single task's group; edges per round
    never outnumber the edges given. Rounds grow with the logarithm of the longest path. An empty table has
    no components.
    """
    now = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "_u")
        large = both.filter("v > u").join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "_u")
        joined = large.join(below, F.col("u") == F.col("_u"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        now = stored(small)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if state == seen:
            break
        seen = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
