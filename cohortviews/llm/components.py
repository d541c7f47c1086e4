"""Connected components of an edge table by alternating large and small stars, without gathering any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortviews.llm.common import stage


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x or 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node of its own.

    Both steps are a two-phase minimum for each node and a join with it, so a node with very many neighbours is
    pre-aggregated and its join can be split. Every round is a written table; rounds grow with the logarithm of the
    longest path. Nulls, loops and repeated edges are ignored.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("a <> b").distinct()
    e = stage(e, "links")
    last = None
    while (now := _signature(e)) != last:
        last = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low"))
        least = least.select("u", F.least("u", "low").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
    centres = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(centres)
