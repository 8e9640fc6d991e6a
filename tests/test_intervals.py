import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from tidewell.operators import metrics
from tidewell.sources.stream import file_stream
from tidewell.streaming import intervals

SCHEMA = "series string, ts timestamp, n long, state string"
BASE = dt.datetime(2024, 1, 1)


def batch(spark, samples):
    frame = spark.createDataFrame(samples, SCHEMA)
    found = metrics.state_intervals(frame, "series", "state", ["ts", "n"])
    return sorted((tuple(r) for r in found.collect()), key=repr)


def so_far(spark, out):
    columns = ["series", "state", "start_ts", "end_ts", "samples"]
    return sorted((tuple(r) for r in intervals.intervals_so_far(spark, out, "series").select(*columns).collect()), key=repr)


def test_stream_equals_batch_over_late_samples_and_restarts(spark, tmp_path):
    rng = random.Random(6)
    samples = []
    for n in range(400):
        at = BASE + dt.timedelta(minutes=n // 2, seconds=rng.randrange(60))
        samples.append((rng.choice("aab"), at, n, rng.choice(["up", "up", "up", "down", None])))
    samples.append(("c", BASE + dt.timedelta(minutes=3), 1000, "up"))  # a series that falls silent
    arrival = sorted(samples, key=lambda s: (s[1] + dt.timedelta(minutes=rng.randrange(9)), s[2]))
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(5):
        part = arrival[k * len(arrival) // 5 : (k + 1) * len(arrival) // 5]
        spark.createDataFrame(part, SCHEMA).repartition(2).write.mode("append").parquet(folder)
        stream = file_stream(spark, folder, SCHEMA)
        found = intervals.state_intervals(stream, "series", "state", "ts", "10 minutes", "n")
        intervals.intervals_to_table(found, out, str(tmp_path / "cp"))
        assert so_far(spark, out) == batch(spark, arrival[: (k + 1) * len(arrival) // 5])
    # What is closed stays as it was given out, and a sample beyond the lateness changes nothing.
    closed = intervals.intervals_so_far(spark, out, "series").where("closed").count()
    assert closed > 20
    late = [("a", BASE, 5000, "down"), ("b", BASE + dt.timedelta(hours=4), 5001, "up")]
    spark.createDataFrame(late, SCHEMA).write.mode("append").parquet(folder)
    found = intervals.state_intervals(file_stream(spark, folder, SCHEMA), "series", "state", "ts", "10 minutes", "n")
    intervals.intervals_to_table(found, out, str(tmp_path / "cp"))
    assert so_far(spark, out) == batch(spark, [*samples, late[1]])


def test_steps_of_one_series():
    held = intervals.NOTHING
    rng = random.Random(1)
    ats = sorted(rng.sample(range(1000), 200))
    states = [rng.choice("xy") for _ in ats]
    wanted = [tuple(r) for r in intervals.extend(None, np.array(ats), np.array(states, object))]
    closed, order = [], sorted(range(200), key=lambda i: ats[i] + rng.randrange(50))
    for lo in range(0, 200, 17):
        part = order[lo : lo + 17]
        # The watermark is below every sample that is still to come.
        mark = min((ats[i] for i in order[lo + 17 :]), default=ats[-1]) - 1
        held, done, open_ = intervals.advance(
            held, np.array([ats[i] for i in part]), np.zeros(len(part), np.int64), np.array([states[i] for i in part], object), mark)
        closed += map(tuple, done)
        assert len(held[6]) <= 60
    assert closed + [tuple(r) for r in open_] == wanted
    held, done, open_ = intervals.advance(held, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object), 10**6)
    assert not held[6] and len(open_) == 1
