"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from .common import store


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b) that has another; the component is its smallest node.

    Each round is written, so that a lost executor repeats one round at most. A node's least neighbour is
    aggregated before it is joined back, so a star of any size is spread over tasks; the window that
    follows holds a node's smaller neighbours, which stars do not pile up. Two
    rounds with the same edges (count and hash) end it.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        smallest = F.min("v").over(Window.partitionBy("u"))
        small = large.withColumn("m", smallest).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        seen = Observation()
        now = small.select("e.u", "e.v").filter("u > v").distinct()
        pairs = store(now.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")), "edges")
        if seen.get == before:
            break
        before = seen.get
    members = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
