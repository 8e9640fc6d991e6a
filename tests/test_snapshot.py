import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators import ranges
from tidewell.operators.snapshot import ChunkedSnapshot

ROW = "id long, v string"
LOG = "id long, pos long, v string, op string"


def final(log):
    last = {}
    for key, pos, v, op in sorted(log, key=lambda r: r[1]):
        last[key] = None if op == "D" else v
    return {k: v for k, v in last.items() if v is not None}


class Source:
    """A table that moves on with its log: some events before a read, some after it."""

    def __init__(self, spark, log, rng):
        self.spark, self.log, self.rng, self.at, self.reads = spark, log, rng, 0, 0

    def position(self):
        self.at = min(len(self.log), self.at + self.rng.randrange(1, 12))
        return self.at

    def read(self):
        self.at = min(len(self.log), self.at + self.rng.randrange(12))
        self.reads += 1
        return self.spark.createDataFrame(list(final(self.log[: self.at]).items()), ROW)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chunks_and_log_give_the_table(spark, tmp_path, seed):
    rng = random.Random(seed)
    log = [(rng.randrange(30), i + 1, f"v{i}", "D" if rng.random() < 0.2 else "U") for i in range(150)]
    source = Source(spark, log, rng)
    source.at = 20
    begin = source.at
    snapshot = ChunkedSnapshot(spark, str(tmp_path / "s"), "id")
    snapshot.plan(source.read(), 6)
    assert [len(c) for c in snapshot.take_all(source.read, source.position, 2)] and not snapshot.pending()
    # The log is kept from some position at or before the first frame's low one on.
    low = snapshot.frames().agg(F.min("low")).first()[0]
    assert begin <= low
    kept = spark.createDataFrame([r for r in log if r[1] > low], LOG)
    got = {r["id"]: r["v"] for r in snapshot.table(kept, "pos").collect()}
    assert got == final(log)
    report = snapshot.report(kept, "pos").collect()
    assert sum(r["rows_read"] for r in report) == snapshot.rows().count()
    assert sum(r["rows_discarded"] for r in report) > 0


def test_a_restart_repeats_no_finished_chunk(spark, tmp_path):
    log = [(i % 20, i + 1, f"v{i}", "U") for i in range(100)]
    source = Source(spark, log, random.Random(5))
    source.at = 40
    path = str(tmp_path / "s")
    snapshot = ChunkedSnapshot(spark, path, "id")
    cuts = snapshot.plan(source.read(), 5)
    source.reads = 0
    taken = snapshot.take(source.read, source.position) + snapshot.take(source.read, source.position)

    def broken():
        # The read fails in a task, after some of it may have been written.
        return source.read().withColumn("v", F.when(F.col("id") >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))

    with pytest.raises(Exception, match="lost"):
        snapshot.take(broken, source.position)
    again = ChunkedSnapshot(spark, path, "id")
    assert again.plan(source.read(), 3) == cuts and again.pending() == [2, 3, 4] and taken == [0, 1]
    frames = {r["chunk"]: tuple(r) for r in again.frames().collect()}
    rest = [c for chunks in again.take_all(source.read, source.position, 2) for c in chunks]
    assert rest == [2, 3, 4]
    later = {r["chunk"]: tuple(r) for r in again.frames().collect()}
    assert {c: later[c] for c in frames} == frames and len(later) == 5
    kept = spark.createDataFrame(log[40:], LOG)
    assert {r["id"]: r["v"] for r in again.table(kept, "pos").collect()} == final(log)


def test_unfinished_snapshot_and_bad_plans(spark, tmp_path):
    snapshot = ChunkedSnapshot(spark, str(tmp_path / "s"), "id")
    empty = spark.createDataFrame([], ROW)
    with pytest.raises(ValueError):
        snapshot.plan(empty, 0)
    assert snapshot.plan(empty, 4) == [] and snapshot.pending() == [0]
    with pytest.raises(ValueError):
        snapshot.rows()
    assert snapshot.take(lambda: empty, lambda: 7) == [0] and snapshot.take(lambda: empty, lambda: 7) == []
    log = spark.createDataFrame([(1, 3, "a", "U"), (None, 4, "b", "U"), (2, 9, "c", "D")], LOG)
    assert [tuple(r) for r in snapshot.table(log, "pos").select("id", "v").collect()] == [(1, "a")]


@pytest.mark.parametrize("kind,values", [("long", list(range(0, 200, 2))), ("string", [f"k{i:03d}" for i in range(100)])])
def test_ranges(spark, kind, values):
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], f"k {kind}")
    cuts = ranges.key_cuts(frame, "k", 7)
    assert cuts == sorted(set(cuts)) and 3 <= len(cuts) <= 6
    got = {r["k"]: r["n"] for r in frame.select("k", ranges.range_number(F.col("k"), cuts).alias("n")).collect()}
    assert got == {v: 0 if v is None else sum(c < v for c in cuts) for v in [*values, None]}
    for first, last in ((0, 0), (1, 3), (len(cuts), len(cuts)), (0, len(cuts))):
        inside = {r["k"] for r in frame.where(ranges.in_range("k", cuts, first, last)).collect()}
        assert inside == {v for v in values if first <= got[v] <= last}


def test_only_the_chunks_range_is_read(spark, tmp_path):
    spark.range(1000).selectExpr("id", "cast(id as string) v").write.parquet(str(tmp_path / "t"))
    plan = spark.read.parquet(str(tmp_path / "t")).where(ranges.in_range("id", [100, 200, 300], 1, 2))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,100)" in text and "LessThanOrEqual(id,300)" in text
