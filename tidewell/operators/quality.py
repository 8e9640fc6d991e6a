"""Data-quality rules, null profiles and unique-constraint reports.

A suite is a list of plain dictionaries, so that it can be kept as JSON:
``{"rule": "row_count", "above": 0}``, ``{"rule": "not_null", "column": "id"}``,
``{"rule": "matches", "column": "name", "pattern": "..."}``,
``{"rule": "max_length", "column": "name", "length": 50}``,
``{"rule": "unique", "column": "id"}`` (rows in groups of more than one),
``{"rule": "duplicate_count", "column": "id"}`` (values that occur more than once),
``{"rule": "schema", "column": "id", "type": "integer"}``.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.text import quoted
from tidewell.operators.keyed import as_list

TYPE_FAMILIES = {
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "string": (T.StringType,),
    "decimal": (T.DecimalType,),
    "number": (T.FloatType, T.DoubleType, T.DecimalType),
    "boolean": (T.BooleanType,),
    "date": (T.DateType,),
    "timestamp": (T.TimestampType, T.TimestampNTZType),
}
_RESULT = "rule string, column string, observed long, threshold long, passed boolean"


def observed_count(rule: dict) -> Column:
    """The aggregate that a one-pass rule observes."""
    kind = rule["rule"]
    if kind == "row_count":
        return F.count("*")
    value = F.col(quoted(rule["column"]))
    if kind == "not_null":
        return F.count_if(value.isNull())
    if kind == "matches":
        return F.count_if(~value.rlike(rule["pattern"]))
    if kind == "max_length":
        return F.count_if(F.length(value) > rule["length"])
    raise ValueError(f"unknown rule {kind}")


def result_entry(rule: dict, observed: Column) -> Column:
    threshold = rule.get("above", 0) if rule["rule"] == "row_count" else rule.get("allowed", 0)
    passed = observed > threshold if rule["rule"] == "row_count" else observed <= threshold
    return F.struct(
        F.lit(rule["rule"]).alias("rule"),
        F.lit(rule.get("column")).cast("string").alias("column"),
        observed.cast("long").alias("observed"),
        F.lit(threshold).cast("long").alias("threshold"),
        passed.alias("passed"),
    )


def duplicate_stats(df: DataFrame, columns) -> DataFrame:
    """``(groups, rows)`` of the values that occur more than once; NULLs are no value.

    Reads the named columns only and counts per value before the shuffle.
    """
    columns = as_list(columns)
    present = reduce(lambda a, b: a & b, [F.col(quoted(c)).isNotNull() for c in columns])
    counts = df.where(present).groupBy(*[F.col(quoted(c)) for c in columns]).agg(
        F.count("*").alias("n")
    )
    return counts.where("n > 1").agg(
        F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")
    )


def run_suite(df: DataFrame, rules: list[dict]) -> DataFrame:
    """One row per rule: ``rule, column, observed, threshold, passed``.

    All counting rules share one aggregate over one scan; the uniqueness rules of a column share
    one grouping of that column; schema rules cost no job.
    """
    spark = df.sparkSession
    parts = []
    schema_rules = [r for r in rules if r["rule"] == "schema"]
    unique_rules = [r for r in rules if r["rule"] in ("unique", "duplicate_count")]
    counted = [r for r in rules if r not in schema_rules and r not in unique_rules]
    if counted:
        totals = df.agg(*[observed_count(r).alias(f"v{i}") for i, r in enumerate(counted)])
        entries = [result_entry(r, F.col(f"v{i}")) for i, r in enumerate(counted)]
        parts.append(totals.select(F.inline(F.array(*entries))))
    for column in dict.fromkeys(r["column"] for r in unique_rules):
        entries = [
            result_entry(r, F.col("rows" if r["rule"] == "unique" else "groups"))
            for r in unique_rules
            if r["column"] == column
        ]
        parts.append(duplicate_stats(df, column).select(F.inline(F.array(*entries))))
    if schema_rules:
        fields = {f.name: f.dataType for f in df.schema.fields}
        rows = []
        for rule in schema_rules:
            fits = isinstance(fields.get(rule["column"]), TYPE_FAMILIES[rule["type"]])
            rows.append(("schema", rule["column"], int(not fits), 0, fits))
        parts.append(spark.createDataFrame(rows, _RESULT))
    return reduce(DataFrame.unionByName, parts)


def run_suite_on(spark, path: str, column: str, value, rules: list[dict], fmt="parquet"):
    """The suite over one partition of a table."""
    from tidewell.sources.tables import read_partition

    return run_suite(read_partition(spark, path, column, value, fmt), rules)


def save_suite(spark, rules: list[dict], path: str) -> None:
    """Keep a suite as one JSON document."""
    spark.createDataFrame([(json.dumps(rules),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def load_suite(spark, path: str) -> list[dict]:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def length_rules(schema: T.StructType, limits: dict[str, int]) -> list[dict]:
    """Length rules for text columns that were declared with a width at the source."""
    return [
        {"rule": "max_length", "column": f.name, "length": limits[f.name]}
        for f in schema.fields
        if f.name in limits
    ]


def null_profile(df: DataFrame, kinds: tuple | None = None) -> DataFrame:
    """``(column_name, nulls)`` for every column, or those of some Spark types, in one pass."""
    names = [f.name for f in df.schema.fields if kinds is None or isinstance(f.dataType, kinds)]
    totals = df.agg(*[F.count_if(F.col(quoted(c)).isNull()).alias(f"n{i}") for i, c in enumerate(names)])
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls"))
        for i, c in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*entries)))


def columns_without_nulls(df: DataFrame, kinds: tuple | None = None) -> DataFrame:
    """Names of the columns that hold no NULL; all of them for an empty table."""
    return null_profile(df, kinds).where("nulls = 0").select("column_name")


def unique_violations(df: DataFrame, constraints: dict[str, list[str]]) -> DataFrame:
    """``(constraint_name, groups, rows)`` per unique constraint."""
    return reduce(
        DataFrame.unionByName,
        [
            duplicate_stats(df, columns).select(
                F.lit(name).alias("constraint_name"), "groups", "rows"
            )
            for name, columns in constraints.items()
        ],
    )
