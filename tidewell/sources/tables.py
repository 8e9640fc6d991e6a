"""Reading tables: snapshot scans, fallbacks, partitions, catalogs, literal rows."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.text import quoted

# Texts of errors that mean "this format is not installed", and error classes that mean "there is
# nothing at this path".
_NO_FORMAT = ("[DATA_SOURCE_NOT_FOUND]", "Failed to find data source: ")
_NO_PATH = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND"}


class MissingConnector(RuntimeError):
    """A format whose connector is not on the classpath."""


@contextmanager
def connector(fmt: str):
    """Turn Spark's failure to find a format into one clear error; others pass."""
    try:
        yield
    except (AnalysisException, Py4JJavaError) as error:
        if any(text in str(error) for text in _NO_FORMAT):
            raise MissingConnector(
                f"format {fmt} is not installed: add its connector to spark.jars.packages"
            ) from error
        raise


def _no_path(error: AnalysisException) -> bool:
    return (error.getCondition() or "").split(".")[0] in _NO_PATH


def read_table(spark: SparkSession, path: str, formats=("parquet",), **options) -> DataFrame:
    """Snapshot scan with the first of ``formats`` that is installed.

    Only a missing format moves on to the next one; every other failure is raised.
    """
    missing = None
    for fmt in formats:
        try:
            with connector(fmt):
                return spark.read.format(fmt).options(**options).load(path)
        except MissingConnector as error:
            missing = error
    raise MissingConnector(f"none of the formats {list(formats)} is installed") from missing


def table_exists(spark: SparkSession, path: str, formats=("parquet",)) -> bool:
    try:
        read_table(spark, path, formats)
    except AnalysisException as error:
        if _no_path(error):
            return False
        raise
    return True


def read_or_empty(spark: SparkSession, path: str, schema, formats=("parquet",)) -> DataFrame:
    """The table, or no rows of ``schema`` where nothing was written yet.

    Only a missing path means an empty table; any other failure is raised.
    """
    try:
        return read_table(spark, path, formats)
    except AnalysisException as error:
        if not _no_path(error):
            raise
        return spark.createDataFrame([], schema)


def read_files_or_empty(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """The same for plain files of a known schema, which is then not inferred."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as error:
        if not _no_path(error):
            raise
        return spark.createDataFrame([], schema)


def read_partition(spark: SparkSession, path: str, column: str, value, fmt="parquet") -> DataFrame:
    """One partition of a partitioned directory; the filter prunes directories."""
    return spark.read.format(fmt).load(path).where(F.col(column) == F.lit(value))


def sql_over_files(spark: SparkSession, path: str, where: str = "true", fmt="parquet", **args):
    """SQL straight over files, with named parameters such as ``:date``."""
    return spark.sql(f"SELECT * FROM {fmt}.{quoted(path)} WHERE {where}", args=args)


def register_catalog(spark: SparkSession, entries: list[dict], root: str = "") -> dict[str, DataFrame]:
    """Temp views for declared tables: name, dataPath, format, partitions (name and type).

    Partition columns get their declared type whatever Spark infers from the directory names.
    """
    tables = {}
    for entry in entries:
        path = f"{root.rstrip('/')}/{entry['dataPath']}" if root else entry["dataPath"]
        df = spark.read.format(entry["format"]).options(**entry.get("options", {})).load(path)
        types = {p["name"]: p["type"] for p in entry.get("partitions", [])}
        unknown = set(types) - set(df.columns)
        if unknown:
            raise ValueError(f"{entry['name']} is not partitioned by {sorted(unknown)}")
        # Only a column whose type differs is cast: a cast would hide the filter from pruning.
        df = df.select(
            *[
                F.col(quoted(f.name)).cast(types[f.name]).alias(f.name)
                if f.name in types and f.dataType.simpleString() != types[f.name]
                else F.col(quoted(f.name))
                for f in df.schema.fields
            ]
        )
        df.createOrReplaceTempView(entry["name"])
        tables[entry["name"]] = df
    return tables


def with_path_partition(df: DataFrame, pattern: str, column: str) -> DataFrame:
    """A column taken from each row's file path by the first group of ``pattern``."""
    return df.withColumn(column, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def list_files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """``(file_path, file_name, size_bytes)`` of the files with a suffix.

    Only the listing is used: file contents are pruned from the scan.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{suffix}")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.col("path").alias("file_path"),
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            F.col("length").alias("size_bytes"),
        )
    )


def read_csv(spark: SparkSession, path: str, schema, header: bool = True) -> DataFrame:
    """CSV with a declared schema; a malformed row fails the query."""
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)


def row_ids(spark: SparkSession, rows: int, start: int = 1, column: str = "id") -> DataFrame:
    return spark.range(start, start + rows).withColumnRenamed("id", column)


def literal_rows(spark: SparkSession, rows: list, schema, ts_columns=(), ts_format=None) -> DataFrame:
    """Hand-written rows with a schema; the named text columns are parsed as timestamps.

    ``schema`` is the final schema, so columns that are NULL in every row keep their type.
    """
    final = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    typed = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name in ts_columns else f.dataType, f.nullable)
            for f in final.fields
        ]
    )
    values = [tuple(r.get(n) for n in typed.names) if isinstance(r, dict) else tuple(r) for r in rows]
    df = spark.createDataFrame(values, typed)
    return df.select(
        *[
            F.to_timestamp(F.col(f.name), ts_format).cast(f.dataType).alias(f.name)
            if f.name in ts_columns
            else F.col(f.name)
            for f in final.fields
        ]
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for every table, in one job.

    The plan grows with the number of tables, not with their rows.
    """
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
