"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of ``links(a, b)``; null ends and loops are dropped.

    Each step rewrites the links so that all hang on smaller nodes; it ends when they form stars. Minima are combined before
    every shuffle, and minima are written before they are joined, so that the join may be split at a node with any share of the links. The number of
    steps grows with the logarithm of the longest chain.
    """
    pairs = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("a is not null and b is not null and hi <> lo")
    edges, name = scratch.keep(pairs.distinct(), "stars"), "stars"
    while not _stars(edges):
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = scratch.keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = scratch.keep(both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "large")
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        ends = F.explode(F.array_distinct(F.array("hi", "lo"))).alias("hi")
        following = scratch.keep(large.join(lowest, "hi").select(ends, F.col("m").alias("lo")).filter("hi <> lo").distinct(), name + "'")
        scratch.drop(name, "least", "large")
        edges, name = following, name + "'"
    tops = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(tops)


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node at most and none that hangs holds others."""
    ends = F.explode(F.array(F.struct(F.col("hi").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")), F.struct(F.col("lo").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))))
    nodes = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.hangs").alias("hangs"), F.max("e.holds").alias("holds"))
    return nodes.filter("hangs + holds > 1").isEmpty()
