"""Streaming forms of the batch operators: the same column logic on unbounded frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import cdc
from tidewell.operators.keyed import absent_by_key, as_list, latest_per_key
from tidewell.operators.mapping import derived_uuid
from tidewell.operators.nested import convert_wall_clock
from tidewell.session import child_folders, scratch_path
from tidewell.sinks.lake import ChangeTable
from tidewell.sources.tables import table_exists


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need TIMESTAMP: wall-clock values are read in the session zone."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def decoded_events(stream: DataFrame, zoned_fields=(), fields=None) -> DataFrame:
    """Business columns of an envelope stream with wall-clock times; stateless.

    Records without an image pass through with NULL business columns.
    """
    return cdc.final_values(convert_wall_clock(stream, zoned_fields), fields)


def drop_repeats(stream: DataFrame, keys, time_column: str, lateness: str) -> DataFrame:
    """At-least-once delivery to once: state is kept for ``lateness`` only."""
    return stream.withWatermark(time_column, lateness).dropDuplicatesWithinWatermark(as_list(keys))


def tumbling_roll_up(
    stream: DataFrame, time_column: str, labels, bucket: str, lateness: str
) -> DataFrame:
    """Count, sum and maximum of ``value`` per label set and bucket; later rows are dropped."""
    labels = as_list(labels)
    return (
        stream.withWatermark(time_column, lateness)
        .groupBy(F.window(time_column, bucket).alias("_w"), *labels)
        .agg(
            F.count("*").alias("n"),
            F.sum("value").alias("total"),
            F.max("value").alias("greatest"),
        )
        .select(F.col("_w.start").alias("bucket"), *labels, "n", "total", "greatest")
    )


def user_sessions(stream: DataFrame, time_column: str, key: str, gap: str, lateness: str) -> DataFrame:
    """Sessions: events of a key with no pause longer than ``gap``."""
    return (
        stream.withWatermark(time_column, lateness)
        .groupBy(F.session_window(time_column, gap).alias("_s"), key)
        .agg(F.count("*").alias("n"))
        .select(key, F.col("_s.start").alias("start_ts"), F.col("_s.end").alias("end_ts"), "n")
    )


def run_available(writer, checkpoint: str, trigger: dict | None = None):
    """Process what has arrived, then stop; the checkpoint makes the next run go on from there.

    With a ``trigger``, such as ``{"processingTime": "1 minute"}``, the query goes on and is handed
    back running.
    """
    running = writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    if trigger is None:
        running.awaitTermination()
    return running


def stream_id(batch: DataFrame) -> str:
    """The id of the query that a micro-batch belongs to. It lives in the checkpoint: a restart keeps
    it, and a new checkpoint, also one in the same folder, has a new one."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("not inside a micro-batch")
    return found


def apply_stream(stream: DataFrame, table: ChangeTable, checkpoint: str, trigger: dict | None = None):
    """Keep a table current from a stream of changes; a replayed epoch is written over.

    Several streams and checkpoints may feed one table: epochs are kept apart by the query's id.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        table.append(batch, epoch, stream_id(batch))

    return run_available(stream.writeStream.foreachBatch(store), checkpoint, trigger)


def store_new_ids(
    batch: DataFrame, epoch: int, path: str, key: str, salt: str, stream: str = "main"
) -> None:
    """Ids for the keys of one batch that no other epoch holds; writing an epoch again replaces it."""
    spark = batch.sparkSession
    new = batch.select(key).where(F.col(key).isNotNull()).distinct()
    if table_exists(spark, path):
        # A replay must not see what its first try wrote.
        own = F.col("stream").eqNullSafe(F.lit(stream)) & (F.col("epoch").cast("long") == epoch)
        known = spark.read.parquet(path).where(~own)
        new = absent_by_key(new, known, key)
    new.withColumn("uuid", derived_uuid(F.col(key), salt)).write.mode("overwrite").parquet(
        f"{path}/stream={stream}/epoch={epoch}"
    )


def map_stream(stream: DataFrame, path: str, key: str, salt: str, checkpoint: str):
    """Give each new key an id, batch by batch; ids are derived, so a replay gives the same ones."""

    def store(batch: DataFrame, epoch: int) -> None:
        store_new_ids(batch, epoch, path, key, salt, stream_id(batch))

    return run_available(stream.writeStream.foreachBatch(store), checkpoint)


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Append a stream's rows to files."""
    return run_available(
        stream.writeStream.outputMode(mode).format("parquet").option("path", path), checkpoint
    )


def updates_to_table(stream: DataFrame, path: str, checkpoint: str):
    """Store every update of an aggregate with its epoch; ``latest_updates`` reads the newest."""

    def store(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/stream={stream_id(batch)}/epoch={epoch}")

    return run_available(stream.writeStream.outputMode("update").foreachBatch(store), checkpoint)


def latest_updates(spark: SparkSession, path: str, keys) -> DataFrame:
    """The newest update of each key, from each query that wrote here: a new checkpoint counts anew,
    so its numbers stand beside the old ones under their own ``stream`` where there are several."""
    rows = spark.read.parquet(path).withColumn("epoch", F.col("epoch").cast("long"))
    newest = latest_per_key(rows, ["stream", *as_list(keys)], "epoch").drop("epoch")
    several = len(child_folders(spark, path, "stream=")) > 1
    return newest if several else newest.drop("stream")


def new_paths(spark: SparkSession, label: str) -> tuple[str, str]:
    """A fresh output folder and its checkpoint folder in the shared folder."""
    base = scratch_path(spark, label)
    return f"{base}/out", f"{base}/checkpoint"
