"""Connected components by alternating large-star and small-star steps, in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import Stages


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """edges (a, b) -> (node, root): root is the smallest node of the component. Nodes without edges are not listed.

    Every step takes the minimum neighbour of each node (combined before the shuffle), writes it, and joins it back to
    the edges, so a node with very many neighbours is split by the adaptive skew join. The number of rounds grows with
    the logarithm of the longest path.
    """
    edges = stages.put(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stages.put(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = stages.put(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        smallest = stages.put(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = stages.put(small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct())
        for old in (edges, least, large, smallest):
            stages.drop(old)
        edges = after
        row = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if row == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = row
