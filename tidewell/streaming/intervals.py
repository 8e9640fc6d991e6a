"""Runs of equal states on a stream: the open interval of each series is kept, closed ones are given out.

Samples are held back until the watermark has passed them, so that late ones within the allowed lateness still find
their place; then they extend or close their series' open interval. A timer wakes a series whose held samples are
passed by while it gets no new ones. What a series keeps is one interval and the samples of the last ``lateness``.

Each call gives the intervals that it closed, for good, and the ones still open as they stand, which the next call of
the series replaces. ``intervals_so_far`` reads both; over samples that were not too late they equal what
``metrics.state_intervals`` finds in the whole table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewell.operators.keyed import as_list
from tidewell.streaming.events import run_available, stream_id

HELD = ("begun boolean, state string, first long, last long, n long, done long, "
        "ats array<long>, ties array<long>, states array<string>")
NOTHING = (False, None, 0, 0, 0, -(1 << 63), [], [], [])


def extend(run, ats, states) -> list[list]:
    """Runs ``[state, first, last, n]`` of samples in order, the first one going on from ``run`` if that fits."""
    runs = [] if run is None else [list(run)]
    if len(ats):
        heads = np.concatenate(([0], np.flatnonzero(states[1:] != states[:-1]) + 1))
        ends = np.concatenate((heads[1:], [len(ats)]))
        for a, b in zip(heads.tolist(), ends.tolist()):
            if runs and runs[-1][0] == states[a]:
                runs[-1][2:] = [int(ats[b - 1]), runs[-1][3] + b - a]
            else:
                runs.append([states[a], int(ats[a]), int(ats[b - 1]), b - a])
    return runs


def advance(held, ats, ties, states, watermark: int):
    """One step of a series: what it keeps, the runs that are closed, and those still open.

    Times are whole microseconds; samples up to ``watermark`` are final, and earlier ones that come later are passed over.
    """
    begun, state, first, last, n, done, *kept = held
    ats = np.concatenate((np.array(kept[0], np.int64), ats))
    ties = np.concatenate((np.array(kept[1], np.int64), ties))
    states = np.concatenate((np.array(kept[2], object), states))
    order = np.lexsort((ties, ats))
    order = order[ats[order] > done]
    ats, ties, states = ats[order], ties[order], states[order]
    ready = int(np.searchsorted(ats, watermark, "right"))
    runs = extend((state, first, last, n) if begun else None, ats[:ready], states[:ready])
    run = runs.pop() if runs else None
    left = ats[ready:], ties[ready:], states[ready:]
    held = (run is not None, *(run or NOTHING[1:5]), max(done, watermark), *(x.tolist() for x in left))
    return held, runs, extend(run, left[0], left[2])


def state_intervals(stream: DataFrame, series, state: str, time: str, lateness: str, tie: str | None = None) -> DataFrame:
    """``series, state, start_ts, end_ts, samples, closed`` as updates.

    ``time`` is a TIMESTAMP; ``tie`` a whole number that orders samples of equal time. NULL states are a state; NULL times are
    left out. A series is one group of a micro-batch: bound its size by the rows of a trigger.
    """
    series = as_list(series)
    rows = stream.where(F.col(time).isNotNull()).withWatermark(time, lateness).select(
        *series, time, F.unix_micros(time).alias("_at"),
        (F.lit(0) if tie is None else F.col(tie)).cast("long").alias("_tie"), F.col(state).cast("string").alias("_state"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.select(*series).schema.fields}

    def step(key: tuple, frames: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        parts = [(f["_at"].to_numpy(np.int64), f["_tie"].fillna(0).to_numpy(np.int64), f["_state"].to_numpy(object))
                 for f in frames if len(f)]
        ats, ties, states = (
            (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object))
        )
        watermark = group.getCurrentWatermarkMs()
        held = group.get if group.exists else NOTHING
        held, closed, open_ = advance(held, ats, ties, states, watermark * 1000)
        group.update(held)
        if held[6]:
            group.setTimeoutTimestamp(max(watermark, held[6][0] // 1000) + 1)
        for final, runs in ((True, closed), (False, open_)):
            if runs:
                frame = pd.DataFrame(runs, columns=["state", "first", "last", "samples"])
                for name, value in zip(series, key):
                    frame[name] = [value] * len(frame)
                frame["closed"] = final
                yield frame[[*series, "state", "first", "last", "samples", "closed"]]

    schema = ", ".join([*(f"`{n}` {k}" for n, k in kinds.items()), "state string, first long, last long, samples long, closed boolean"])
    found = rows.groupBy(*series).applyInPandasWithState(step, schema, HELD, "update", GroupStateTimeout.EventTimeTimeout)
    return found.select(
        *series, F.col("state").alias(state), F.timestamp_micros("first").alias("start_ts"),
        F.timestamp_micros("last").alias("end_ts"), "samples", "closed",
    )


def intervals_to_table(intervals: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Store what each epoch gave; writing an epoch again replaces it."""

    def store(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/stream={stream_id(batch)}/epoch={epoch}")

    return run_available(intervals.writeStream.outputMode("update").foreachBatch(store), checkpoint, trigger)


def intervals_so_far(spark: SparkSession, path: str, series) -> DataFrame:
    """Every closed interval, and of each series the open ones of its last epoch."""
    series = as_list(series)
    rows = spark.read.parquet(path).withColumn("epoch", F.col("epoch").cast("long"))
    newest = F.max("epoch").over(Window.partitionBy("stream", *series))
    still = rows.select("*", newest.alias("_newest")).where("NOT closed AND epoch = _newest").drop("_newest")
    return rows.where("closed").unionByName(still).drop("stream", "epoch")
