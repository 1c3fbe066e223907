"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import checkpointed


def _neighbours(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(links: DataFrame) -> DataFrame:
    """Each (a, b) with the least of a and its neighbours; minima are combined before the shuffle."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return links.join(least, "a")


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the least node of its component.

    Rounds of large and small stars until nothing changes: each node is linked to
    the least node it knows, which takes about the logarithm of the number of nodes
    in rounds. Each round is written to the shared folder, so a lost executor costs one round. Links
    of a node to itself count for nothing; no links give no rows.
    """
    now = checkpointed(links.select("a", "b").where("a <> b").distinct())
    state = None
    while True:
        large = _with_least(_neighbours(now)).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small = _with_least(down)
        now = checkpointed(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = tuple(seen)
