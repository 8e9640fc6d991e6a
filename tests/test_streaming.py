import datetime as dt

from pyspark.sql import functions as F

from tidewell.operators import cdc
from tidewell.operators.metrics import with_labels
from tidewell.sinks.lake import ChangeTable
from tidewell.sources.stream import file_stream
from tidewell.streaming import events as streaming

SCHEMA = "id int, v string, pos long, op string"


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    log = spark.range(200).select(
        (F.col("id") % 23).cast("int").alias("id"), F.col("id").cast("string").alias("v"), F.col("id").alias("pos"),
        F.when(F.col("id") % 5 == 0, "D").otherwise("U").alias("op"))
    folder = str(tmp_path / "in")
    table = ChangeTable(spark, str(tmp_path / "table"), SCHEMA, "id", "pos")
    # Later positions arrive first.
    for low, high in ((100, 200), (0, 50), (50, 100)):
        log.where((F.col("pos") >= low) & (F.col("pos") < high)).coalesce(1).write.mode("append").parquet(folder)
        streaming.apply_stream(file_stream(spark, folder, SCHEMA), table, str(tmp_path / "cp"))
        table.compact()
    batch = cdc.live_rows(cdc.latest_changes(log, "id", "pos")).drop("op")
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, batch.collect()))


def test_wall_clock_on_a_stream(spark, tmp_path):
    schema = "op_type string, before struct<id int, at string>, after struct<id int, at string>"
    rows = [("I", None, (1, "2025-08-08T07:39:21.253742+07:00")), ("D", (2, None), None), (None, None, None)]
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows, schema).write.parquet(folder)
    decoded = streaming.decoded_events(file_stream(spark, folder, schema), ["before.at", "after.at"])
    streaming.to_table(decoded, out, str(tmp_path / "cp"))
    got = {r["op_type"]: (r["id"], r["at"]) for r in spark.read.parquet(out).collect()}
    assert got == {"I": (1, dt.datetime(2025, 8, 8, 7, 39, 21, 253000)), "D": (2, None), None: (None, None)}


def test_late_rows_beyond_the_watermark_are_dropped(spark, tmp_path):
    schema = "ts timestamp, label string, value double"
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    base = dt.datetime(2024, 1, 1)

    def deliver(*hours):
        spark.createDataFrame([(base + dt.timedelta(hours=h), "l", 1.0) for h in hours], schema).coalesce(1).write.mode("append").parquet(folder)
        rolled = streaming.tumbling_roll_up(file_stream(spark, folder, schema), "ts", "label", "1 hour", "2 hours")
        streaming.updates_to_table(rolled, out, str(tmp_path / "cp"))

    deliver(0, 10)
    deliver(9, 1)
    counts = {r["bucket"].hour: r["n"] for r in streaming.latest_updates(spark, out, ["bucket", "label"]).collect()}
    assert counts == {0: 1, 9: 1, 10: 1}


def test_mapping_stream_is_stable(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for keys in (["a", "b", None], ["b", "c"]):
        spark.createDataFrame([(k,) for k in keys], "k string").coalesce(1).write.mode("append").parquet(folder)
        streaming.map_stream(file_stream(spark, folder, "k string"), out, "k", "s", str(tmp_path / "cp"))
    rows = spark.read.parquet(out).collect()
    assert sorted(r["k"] for r in rows) == ["a", "b", "c"]
    assert len({r["uuid"] for r in rows}) == 3


def test_replayed_ids_are_the_same(spark, tmp_path):
    out = str(tmp_path / "out")
    keys = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")

    def rows():
        return sorted((r["k"], r["uuid"]) for r in spark.read.parquet(out).collect())

    streaming.store_new_ids(keys, 0, out, "k", "s")
    first = rows()
    streaming.store_new_ids(keys, 0, out, "k", "s")
    assert rows() == first and [k for k, _ in first] == ["a", "b"]
    streaming.store_new_ids(keys.unionByName(spark.createDataFrame([("c",)], "k string")), 1, out, "k", "s")
    assert [k for k, _ in rows()] == ["a", "b", "c"]


def test_labels_on_a_stream_frame(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([({"dag_id": "d"}, 1.0)], "labels map<string,string>, value double").write.parquet(folder)
    stream = file_stream(spark, folder, "labels map<string,string>, value double")
    assert with_labels(stream, ["dag_id", "none"]).isStreaming
