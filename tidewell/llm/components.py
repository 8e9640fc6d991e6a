"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: each neighbour above a node points to the node's least neighbour. Small star: each
    node and its neighbours below it point to the least of them."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    least = least.select("node", F.least("node", "m").alias("m"))
    joined = both.join(least, F.col("a") == F.col("node"))
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        # Every link stands once, from the larger end to the smaller one.
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("m").alias("b"))
        )
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``: the least node reachable.

    Each round does a large and a small star and writes the links that are left; nothing is
    gathered on the driver but one count. Rounds grow with the logarithm of the longest path. Groups
    are combined before each shuffle, so a node with very many links is no load on one task. Links of
    a node with itself, repeated links and null ends have no effect.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stage(links.where("a <> b").distinct(), "links")
    # A round that changes nothing leaves number and sum of the links' hashes as they are.
    mark = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    before = tuple(links.agg(*mark).first())
    while before[0]:
        links = stage(_star(_star(links, True), False), "links")
        after = tuple(links.agg(*mark).first())
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
