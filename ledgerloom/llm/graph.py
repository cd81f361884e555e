"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of edges(a, b); self-loops are ignored.

    Each round moves every edge towards smaller nodes; the rounds end when the edge set stays the same, after a number of
    rounds that grows with the logarithm of the longest path. Only counts and checksums reach the driver.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    seen = _sum(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        now = cut(moved.select("e.*").filter("u <> v").distinct())
        after = _sum(now)
        if after == seen:
            break
        seen = after
    stars = now.groupBy("u").agg(F.min("v").alias("component"))
    return stars.select(F.col("u").alias("node"), "component").unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _sum(edges: DataFrame) -> tuple[int, int, int]:
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.shiftright(h, 32)), F.lit(0)), F.coalesce(F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(0))).first()
    return int(row[0]), int(row[1]), int(row[2])
