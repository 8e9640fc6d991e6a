"""Database tables over JDBC: aggregates computed at the source, batched loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_options(url: str, sql: str, **options) -> dict:
    """Options of a read whose query the database computes, such as a count for one day."""
    return {"url": url, "query": sql, **options}


def table_options(url: str, table: str, split=None, **options) -> dict:
    """Options of a table read; ``split`` is ``(column, low, high, parts)`` for parallel ranges."""
    found = {"url": url, "dbtable": table, **options}
    if split:
        column, low, high, parts = split
        found |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(parts),
        }
    return found


def load_options(url: str, table: str, batch: int = 10_000, connections=None, **options) -> dict:
    """Options of a load in batches of ``batch`` rows by at most ``connections`` writers."""
    found = {"url": url, "dbtable": table, "batchsize": str(batch), **options}
    if connections:
        found["numPartitions"] = str(connections)
    return found


def read_query(spark: SparkSession, url: str, sql: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(url, sql, **options)).load()


def read_jdbc_table(spark: SparkSession, url: str, table: str, split, **options) -> DataFrame:
    """``split`` is how the table is cut into parallel reads, or None, said on purpose, for one task."""
    return spark.read.format("jdbc").options(**table_options(url, table, split, **options)).load()


def append_batches(df: DataFrame, url: str, table: str, connections: int, batch: int = 10_000, **options):
    """Append over at most ``connections`` connections; the columns come from the frame, and the table
    is created where it is absent."""
    chosen = load_options(url, table, batch, connections, **options)
    df.write.format("jdbc").options(**chosen).mode("append").save()


def replace_jdbc_table(
    df: DataFrame, url: str, table: str, connections: int, keep_definition=False, batch=10_000, **options
):
    """Drop and create again, or with ``keep_definition`` truncate and load."""
    chosen = load_options(url, table, batch, connections, **options)
    chosen["truncate"] = str(keep_definition).lower()
    df.write.format("jdbc").options(**chosen).mode("overwrite").save()
