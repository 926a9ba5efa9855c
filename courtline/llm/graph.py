"""Connected components by alternating stars, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes in ``edges`` (a, b: long): the smallest node that can be reached.

    Each round, one job, hangs the larger neighbours of a node below its smallest neighbour, then the smaller ones;
    the number of rounds grows with the logarithm of the graph's diameter. The rows are two longs; of the joins of
    all edges with one row a node, Spark splits the partition of a hub at run time, as its other side is unique."""
    now, state = _round(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now, seen = _round(small)
        if seen == state:
            break
        state = seen
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _round(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, staged, and what tells two sets of edges apart."""
    watch = Observation()
    out = staged(edges.observe(watch, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("sum")), "edges")
    return out, (watch.get["n"], watch.get["sum"])
