"""Connected components of links, by alternating large and small stars; no neighbourhood is ever collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node of ``links`` (a, b; whole numbers)."""
    edges = written(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = _state(edges)
    while True:
        # large star: each node hands its larger neighbours to the smallest node it knows
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: each node hands its smaller neighbours, and itself, to the smallest of them
        large = written(large.where("a != b").distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b")))
        edges = written(small.where("a != b").distinct(), "links")
        after = _state(edges)
        if after == before:  # every edge now leads to the smallest node of its component
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
