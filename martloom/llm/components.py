"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.frames import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root (the smallest node reachable) of every node that an edge names.

    Every round points each neighbour of a node at the smallest of them (large star), then the smaller ones at the
    smallest (small star), until no pair changes; rounds grow with the logarithm of the longest chain. Minima are
    combined in the map tasks, and a round's pairs are written before the next reads them. No edges give no rows.
    """
    pairs = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "components")
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        linked = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        pairs = stored(linked.distinct(), "components")
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
