"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v); the component is its smallest node.

    Each round links neighbours to the smallest node seen (larger ones first, then smaller ones) and is written to
    the shared folder. Rounds grow with the logarithm of the longest path. Self-loops and repeated edges are fine.
    """
    now = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v"), F.col("v"))
            ).distinct()
        before = mark
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m"))
        now = stored(small.where("u <> v").distinct(), "edges")
