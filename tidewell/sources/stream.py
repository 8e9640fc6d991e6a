"""Streams of change events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.sources.tables import connector


def file_stream(
    spark: SparkSession, path: str, schema, fmt="parquet", files_per_trigger=None, **options
) -> DataFrame:
    """New files of a folder as they arrive."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def topic_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A topic's records as text; needs the Kafka connector on the classpath."""
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, **options}
    with connector("kafka"):
        raw = spark.readStream.format("kafka").options(**settings).load()
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("arrived"),
    )
