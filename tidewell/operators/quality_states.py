"""Quality suites over any range of partitions from stored partial states, without reading the table again.

The state of a partition holds a count for each counting rule and, for each column that must be unique, the number of rows of
each value's 128-bit hash. Counts of partitions add up; values that repeat across partitions are found by adding up
their hashes' counts. A partition that is added again replaces its state.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.text import quoted
from tidewell.operators.quality import TYPE_FAMILIES, load_suite, observed_count, result_entry, save_suite
from tidewell.session import child_folders

UNIQUE = ("unique", "duplicate_count")
STATE = "slot int, a long, b long, n long"


def partial_states(df: DataFrame, rules: list[dict], partition: Column) -> DataFrame:
    """``(part, slot, a, b, n)``: what each partition adds to each rule, or to each value of a column that must be unique.

    A slot is the place of a rule, or of the first rule of its column. All counting rules share one grouping of the
    table by partition; each column that must be unique is grouped by partition and value.
    """
    part = partition.cast("string").alias("part")
    fields = {f.name: f.dataType for f in df.schema.fields}
    counts = {}
    for slot, rule in enumerate(rules):
        if rule["rule"] == "schema":
            counts[slot] = F.lit(int(not isinstance(fields.get(rule["column"]), TYPE_FAMILIES[rule["type"]])))
        elif rule["rule"] not in UNIQUE:
            counts[slot] = observed_count(rule)
    grouped = df.groupBy(part).agg(F.count("*").alias("rows"), *[c.cast("long").alias(f"n{s}") for s, c in counts.items()])
    none = F.lit(None).cast("long")
    entries = [F.struct(F.lit(s).alias("slot"), none.alias("a"), none.alias("b"), F.col(f"n{s}").alias("n")) for s in counts]
    parts = [grouped.select("part", F.inline(F.array(*entries)))] if entries else []
    for slot in unique_slots(rules).values():
        value = F.col(quoted(rules[slot]["column"]))
        hashes = [F.xxhash64(F.lit(seed), value).alias(name) for seed, name in ((1, "a"), (2, "b"))]
        parts.append(
            df.where(value.isNotNull()).groupBy(part, *hashes).agg(F.count("*").alias("n"))
            .select("part", F.lit(slot).alias("slot"), "a", "b", "n")
        )
    return reduce(DataFrame.unionByName, parts)


def unique_slots(rules: list[dict]) -> dict[str, int]:
    """The slot of each column that must be unique."""
    slots: dict[str, int] = {}
    for slot, rule in enumerate(rules):
        if rule["rule"] in UNIQUE:
            slots.setdefault(rule["column"], slot)
    return slots


def merged_report(states: DataFrame, rules: list[dict]) -> DataFrame:
    """The suite's result over all partitions in ``states``, as ``quality.run_suite`` gives it."""
    shared = unique_slots(rules)
    added = states.groupBy("slot", "a", "b").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    repeated = F.col("a").isNotNull() & (F.col("n") > 1)

    def observed(slot: int, rule: dict) -> Column:
        if rule["rule"] in UNIQUE:
            mine = (F.col("slot") == shared[rule["column"]]) & repeated
            found = F.sum(F.when(mine, F.col("n") if rule["rule"] == "unique" else F.lit(1)))
        else:
            found = F.sum(F.when(F.col("slot") == slot, F.col("most") if rule["rule"] == "schema" else F.col("n")))
        return F.coalesce(found, F.lit(0)).cast("long")

    totals = added.agg(*[observed(i, r).alias(f"v{i}") for i, r in enumerate(rules)])
    return totals.select(F.inline(F.array(*[result_entry(r, F.col(f"v{i}")) for i, r in enumerate(rules)])))


class QualityStates:
    """States of a table's partitions under one suite, kept in a folder."""

    def __init__(self, spark: SparkSession, path: str, rules: list[dict]):
        self.spark, self.path = spark, path.rstrip("/")
        if child_folders(spark, self.path, "suite"):
            if load_suite(spark, f"{self.path}/suite") != json.loads(json.dumps(rules)):
                raise ValueError("these states were made by another suite")
        else:
            save_suite(spark, rules, f"{self.path}/suite")
        self.rules = rules

    def add(self, df: DataFrame, partition: Column) -> None:
        """Make the states of all partitions in ``df``; those that were there already are replaced."""
        states = partial_states(df, self.rules, partition)
        # One file for each partition and slot range of values, however many tasks wrote it.
        dealt = states.repartition("part", F.pmod(F.coalesce("a", F.lit(0)), F.lit(4)))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{self.path}/states")

    def states(self, first=None, last=None) -> DataFrame:
        """The states of partitions from ``first`` to ``last``, both included; only their folders are read."""
        states = self.spark.read.schema(f"{STATE}, part string").parquet(f"{self.path}/states")
        for bound, beyond in ((first, F.col("part") >= F.lit(first)), (last, F.col("part") <= F.lit(last))):
            if bound is not None:
                states = states.where(beyond)
        return states

    def report(self, first=None, last=None) -> DataFrame:
        return merged_report(self.states(first, last), self.rules)
