"""Comparing a source with its target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.keyed import as_list


def count_difference(source: DataFrame, target: DataFrame, keys) -> DataFrame:
    """Rows per key on both sides: ``keys, source, target, diff`` with diff = source - target.

    Both sides go through one grouping that combines before the shuffle; a NULL key is a group.
    """
    keys = as_list(keys)
    tagged = source.select(*keys, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        target.select(*keys, F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    return tagged.groupBy(*keys).agg(
        F.sum("_s").alias("source"),
        F.sum("_t").alias("target"),
        (F.sum("_s") - F.sum("_t")).alias("diff"),
    )


def metric_difference(source: DataFrame, target: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """``(metric, source, target, diff)`` for whole-table aggregates of both sides.

    Each side is aggregated in one pass, then the two single rows are laid side by side by name.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        totals = df.agg(*[m.cast("double").alias(f"m{i}") for i, m in enumerate(metrics.values())])
        entries = [
            F.struct(F.lit(label).alias("metric"), F.col(f"m{i}").alias("value"))
            for i, label in enumerate(metrics)
        ]
        return totals.select(F.inline(F.array(*entries))).withColumn("side", F.lit(name))

    both = side(source, "source").unionByName(side(target, "target"))
    value = {s: F.max(F.when(F.col("side") == s, F.col("value"))) for s in ("source", "target")}
    return both.groupBy("metric").agg(
        value["source"].alias("source"),
        value["target"].alias("target"),
        (value["source"] - value["target"]).alias("diff"),
    )


def side_by_side(frames: dict[str, tuple[DataFrame, str]], key: str) -> DataFrame:
    """Merge aggregated frames on one id, one value column per frame; missing values are NULL.

    ``frames`` maps a column name to a frame and its value column; each frame has one row per id.
    One grouping replaces a chain of outer joins.
    """
    stacked = None
    for name, (df, value) in frames.items():
        part = df.select(
            F.col(key),
            *[
                (F.col(value) if other == name else F.lit(None)).cast("double").alias(other)
                for other in frames
            ],
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(key).agg(*[F.max(name).alias(name) for name in frames])
