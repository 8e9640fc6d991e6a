"""A snapshot of a table in chunks while its changes keep flowing.

The key space is cut into ranges. Each chunk of ranges is read between two positions of the change log, its frame: the low
one is taken before the read and the high one after it. Which of the changes inside the frame the read saw cannot be known, so
rows whose key changed there are discarded and the log's events stand for them. A row that is kept is as good as
an event at the high position: it replaces what the log said before and yields to what it says later.
No lock is held, and the log need not reach back beyond the first frame.

Chunks that are finished are on record, so a run that was ended goes on with the first one that is not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.cdc import live_rows
from tidewell.operators.keyed import absent_by_key, combined, latest_per_key, present_by_key
from tidewell.operators.ranges import in_range, key_cuts, range_number
from tidewell.session import child_folders

MOST_CHUNKS = 100_000  # frames are broadcast: 24 bytes each

FRAME = "chunk int, low long, high long, first int"


def changed_in_frames(log: DataFrame, frames: DataFrame, key: str, position: str, cuts: list) -> DataFrame:
    """Keys with an event inside their chunk's frame ``(low, high]``; a hot key comes once per task."""
    frames = F.broadcast(frames.select(F.col("chunk").alias("_chunk"), "low", "high"))
    placed = log.select(key, F.col(position).cast("long").alias("_at")).where(F.col(key).isNotNull())
    placed = placed.withColumn("_range", range_number(F.col(key), cuts))
    inside = placed.join(frames, (F.col("_range") == F.col("_chunk")) & (F.col("_at") > F.col("low")) & (F.col("_at") <= F.col("high")))
    return combined(inside, key)


def surviving_rows(rows: DataFrame, frames: DataFrame, log: DataFrame, key: str, position: str, cuts: list) -> DataFrame:
    """Chunk rows whose key did not change inside their frame, at the frame's high position.

    ``rows`` carry their ``chunk``.
    """
    kept = absent_by_key(rows, changed_in_frames(log, frames, key, position, cuts), key)
    ends = F.broadcast(frames.select("chunk", F.col("high").alias(position)))
    return kept.join(ends, "chunk").drop("chunk")


def settled(
    rows: DataFrame, frames: DataFrame, log: DataFrame, key: str, position: str, cuts: list, op_column: str = "op"
) -> DataFrame:
    """The table after snapshot and log: the newest of surviving rows and events of each key, if no delete."""
    kept = surviving_rows(rows, frames, log, key, position, cuts).withColumn(op_column, F.lit("R"))
    events = log.where(F.col(key).isNotNull()).withColumn(position, F.col(position).cast("long"))
    both = kept.unionByName(events, allowMissingColumns=True)
    return live_rows(latest_per_key(both, key, position), op_column)


class ChunkedSnapshot:
    """A snapshot under way, kept in a folder: its cuts, the rows of each take, and the frames of finished takes.

    A take reads some chunks in one job. Its frame is written last and in one piece; a take without a frame
    does not count and is written over by the next one, which begins at the same chunk.
    """

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def plan(self, source: DataFrame, chunks: int, cuts: list | None = None) -> list:
        """Cut the key space once; a folder that has a plan keeps it."""
        if not 0 < chunks <= MOST_CHUNKS:
            raise ValueError(f"chunks must be 1 to {MOST_CHUNKS}")
        if not child_folders(self.spark, self.path, "plan"):
            cuts = sorted(set(key_cuts(source, self.key, chunks) if cuts is None else cuts))
            kind = source.schema[self.key].dataType.simpleString()
            self.spark.createDataFrame([(cuts,)], f"cuts array<{kind}>").write.mode("overwrite").parquet(f"{self.path}/plan")
        return self.cuts

    @property
    def cuts(self) -> list:
        return self.spark.read.parquet(f"{self.path}/plan").first()["cuts"]

    def frames(self) -> DataFrame:
        """``(chunk, low, high, first)`` of the finished chunks; ``first`` is the first chunk of the take."""
        if not child_folders(self.spark, f"{self.path}/frames", "first="):
            return self.spark.createDataFrame([], FRAME)
        return self.spark.read.schema(FRAME).parquet(f"{self.path}/frames")

    def pending(self) -> list[int]:
        """Chunks without a frame, in order."""
        done = {r["chunk"] for r in self.frames().select("chunk").collect()}
        return [c for c in range(len(self.cuts) + 1) if c not in done]

    def take(self, read: Callable[[], DataFrame], position: Callable[[], int], most: int = 1) -> list[int]:
        """Read the next chunks, at most ``most``, between two calls of ``position``; their numbers.

        ``read`` gives the source as it is now; only the chunks' key range is read of it, by bounds that reach the scan.
        Rows without a key belong to no row of a keyed table and are left out.
        """
        pending, cuts = self.pending(), self.cuts
        chunks = [c for i, c in enumerate(pending[:most]) if c == pending[0] + i]
        if not chunks:
            return []
        first, last = chunks[0], chunks[-1]
        low = position()
        rows = read().where(in_range(self.key, cuts, first, last))
        rows = rows.withColumn("chunk", F.lit(first) if first == last else range_number(F.col(self.key), cuts))
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/first={first}")
        high = position()
        frame = self.spark.createDataFrame([(c, low, high) for c in chunks], "chunk int, low long, high long")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/frames/first={first}")
        return chunks

    def take_all(self, read, position, most: int = 1) -> Iterator[list[int]]:
        """Takes until no chunk is pending."""
        while chunks := self.take(read, position, most):
            yield chunks

    def rows(self) -> DataFrame:
        """The rows of the finished takes with their chunk, as read."""
        firsts = sorted({r["first"] for r in self.frames().select("first").distinct().collect()})
        if not firsts:
            raise ValueError("no chunk is finished")
        return self.spark.read.parquet(*[f"{self.path}/rows/first={f}" for f in firsts])

    def table(self, log: DataFrame, position: str, op_column: str = "op") -> DataFrame:
        """The table after the finished chunks and the log."""
        return settled(self.rows(), self.frames(), log, self.key, position, self.cuts, op_column)

    def report(self, log: DataFrame, position: str) -> DataFrame:
        """Per finished chunk its frame, the rows read, and those discarded."""
        rows = self.rows()
        gone = present_by_key(rows, changed_in_frames(log, self.frames(), self.key, position, self.cuts), self.key)
        counts = rows.select("chunk", F.lit(1).alias("r"), F.lit(0).alias("d")).unionByName(
            gone.select("chunk", F.lit(0).alias("r"), F.lit(1).alias("d"))
        ).groupBy("chunk").agg(F.sum("r").alias("rows_read"), F.sum("d").alias("rows_discarded"))
        return self.frames().select("chunk", "low", "high").join(counts, "chunk", "left").na.fill(
            0, ["rows_read", "rows_discarded"]
        )
