"""The registry of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its independent check, where SQL can express it."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql.strip()
        return function

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{table}.parquet")
