"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstream.session import shared_dir


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b``; the root is the smallest node reachable.

    Each round links nodes to the smallest neighbour they know (large star), then to
    the smallest below them (small star), until nothing changes, after a number of
    rounds in the order of the squared logarithm of the nodes. Every step is a grouped
    minimum, pre-aggregated, and a join; no neighbour list is gathered anywhere. The
    minima are checkpointed before the join, so that a node of many neighbours is a skewed
    key of two plain shuffles, which the adaptive plan splits. Rounds are checkpointed
    too. Loops and repeated edges change nothing; no edges give no rows.
    """
    shared_dir(edges.sparkSession)
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    links = edges.where(F.col("a") != F.col("b"))
    links = links.select(larger.alias("a"), smaller.alias("b")).distinct().checkpoint()
    state = _state(links)
    while state[0]:
        links = _small_star(_large_star(links)).checkpoint()
        after = _state(links)
        if after == state:
            break
        state = after
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(links: DataFrame) -> tuple:
    """Count and order-free sum of the links; equal for equal sets of links."""
    mixed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(links.agg(F.count("*"), F.sum(mixed), F.sum(F.hash("a", "b"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).checkpoint()
    joined = both.join(least, "a").where(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m")).checkpoint()
    below = links.join(least, "a").where(F.col("b") != F.col("m"))
    moved = below.select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = least.select("a", F.col("m").alias("b"))
    return kept.unionByName(moved).distinct()
