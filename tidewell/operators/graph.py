"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.keyed import combined
from tidewell.session import staged


def _to_least(links: DataFrame, both_ways: bool) -> DataFrame:
    """One step: neighbours of a node are linked to the least of them instead.

    ``both_ways`` takes the neighbours above the node, the other form those below it and the node itself.
    """
    ends = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both_ways else links
    least = combined(ends, "u", F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    met = ends.join(least.withColumnRenamed("u", "_u"), F.col("u") == F.col("_u"))
    if both_ways:
        moved = met.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        moved = met.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            least.select("u", F.col("least").alias("v"))
        )
    return moved.where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``links (u, v)``: the least node that can be reached.

    The number of rounds grows with the logarithm of the longest path. Each round is written down; the driver gets one
    count of it. Groups are combined before each shuffle, so a node may have any number of links.
    """
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    links = staged(links, "links")
    # A round that changes nothing leaves number and sum of the links as they are.
    mark = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    before = tuple(links.agg(*mark).first())
    while before[0]:
        links = staged(_to_least(_to_least(links, True), False), "links")
        after = tuple(links.agg(*mark).first())
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
