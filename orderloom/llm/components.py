"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderloom.llm.stages import discard, stage


def _large(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    below = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return below.union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame, first: str, second: str) -> DataFrame:
    """(node, root) for every node that has a link; the root is the smallest node reachable.

    ``links`` are pairs of whole numbers in any order, repeats and loops allowed, nulls
    ignored. Each round is two aggregations with joins back, so a node with very many
    links is combined before the shuffle and split by skew handling after it; the number
    of rounds grows with the logarithm of the longest path. Every round is a stage
    table, and the one before it is removed. The root itself is not listed.
    """
    edges = stage(
        links.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b"))
        .where("a > b").distinct(),
        "links",
    )
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, old = mark, edges
        edges = stage(_small(_large(old).distinct()).distinct(), "stars")
        discard(old)
