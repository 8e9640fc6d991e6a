import datetime as dt

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import clock, codes
from tidewell.operators import cdc, nested
from tidewell.operators.customer_image import generate_customer_events
from tidewell.sources.tables import literal_rows

EVENT_SCHEMA = (
    "`table` string, op string, op_ts timestamp, current_ts timestamp, pos string, "
    "primary_keys string, CUST_ID int, NAME string, CITY string, STATE string"
)


def sample(spark):
    """An insert, an update and a delete of key 5; the delete's columns are all NULL."""
    head = {"table": "GGADMIN.CUSTOMER", "primary_keys": "CUST_ID", "CUST_ID": 5}
    rows = [
        {**head, "op": "c", "op_ts": "2025-09-08 13:18:08.000000", "current_ts": "2025-09-08 13:21:27.096000",
         "pos": "00000000040000001924", "NAME": "Le Van C", "CITY": "Hue", "STATE": "HUE"},
        {**head, "op": "u", "op_ts": "2025-09-08 13:18:20.000000", "current_ts": "2025-09-08 13:21:27.358000",
         "pos": "00000000040000002244", "NAME": "Le Van C", "CITY": "Da Nang", "STATE": "HUE"},
        {**head, "op": "d", "op_ts": "2025-09-08 13:19:18.000000", "current_ts": "2025-09-08 13:21:27.362000",
         "pos": "00000000040000002957"},
    ]
    df = literal_rows(spark, rows, EVENT_SCHEMA, ("op_ts", "current_ts"), clock.EVENT_TS_FORMAT)
    known, unknown = cdc.normalise_operations(df, "op")
    assert unknown.isEmpty()
    return known


def test_key_five(spark):
    log = sample(spark)
    empty = spark.createDataFrame([], "CUST_ID int, NAME string, CITY string, STATE string")
    order = ["op_ts", cdc.position_number(F.col("pos"))]
    upserts = cdc.apply_changes(empty, log.where("op <> 'D'"), "CUST_ID", order)
    assert [tuple(r) for r in upserts.collect()] == [(5, "Le Van C", "Da Nang", "HUE")]
    assert cdc.apply_changes(upserts, log, "CUST_ID", order).count() == 0
    assert log.schema["op_ts"].dataType == T.TimestampType()


def test_applying_twice_changes_nothing(spark):
    table = spark.range(50).select("id", F.lit("old").alias("v"))
    log = spark.range(30, 70).select(
        "id", F.lit("new").alias("v"), F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, "D").otherwise("U").alias("op"))
    once = cdc.apply_changes(table, log, "id", "pos")
    twice = cdc.apply_changes(once, log, "id", "pos")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_batches_of_other_keys_commute(spark):
    table = spark.range(20).select("id", F.lit("old").alias("v"))

    def batch(low, high):
        return spark.range(low, high).select(
            "id", F.lit("new").alias("v"), F.lit(1).alias("pos"),
            F.when(F.col("id") % 2 == 0, "D").otherwise("U").alias("op"))

    a, b = batch(0, 10), batch(10, 30)
    one = cdc.apply_changes(cdc.apply_changes(table, a, "id", "pos"), b, "id", "pos")
    other = cdc.apply_changes(cdc.apply_changes(table, b, "id", "pos"), a, "id", "pos")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))


def test_envelope_thirds(spark):
    events = generate_customer_events(spark, 30)
    counts = {r["op_type"]: r["count"] for r in events.groupBy("op_type").count().collect()}
    assert counts == {"I": 10, "U": 10, "D": 10}
    assert events.where("op_type = 'I' and before is not null").isEmpty()
    assert events.where("op_type = 'D' and after is not null").isEmpty()
    image = events.schema["after"].dataType
    assert len(image.fields) == 141
    booleans = [f.name for f in image.fields if isinstance(f.dataType, T.BooleanType)]
    assert len(booleans) == 16
    assert image["customer_id"].dataType == T.LongType()


def test_wide_ids_are_not_cut(spark):
    event = generate_customer_events(spark, 1, start=1_234_567_890).first()
    image = event["after"] or event["before"]
    assert image["tax_code"] == "TAX1234567890"
    assert event["pos"] == "20000000001234567890"


def test_final_values_for_one_operation(spark):
    events = generate_customer_events(spark, 3).select("op_type", "before", "after")
    for op, name in (("I", "Customer 1"), ("U", "Customer 2 New"), ("D", "Customer 3")):
        rows = cdc.final_values_for(events.where(F.col("op_type") == op), op, ["customer_id", "full_name"])
        assert rows.columns == ["customer_id", "full_name", "op_type"]
        assert [r["full_name"] for r in rows.collect()] == [name]
    assert cdc.final_values_for(events, "X", ["customer_id"]).columns == events.columns


def test_final_values_of_unknown_operation(spark):
    df = spark.createDataFrame([("X", (1,), (2,))], "op_type string, before struct<a int>, after struct<a int>")
    assert cdc.final_values(df).first()["a"] is None


def test_merge_policies(spark):
    schema = "op_type string, before struct<a int, b int>, after struct<a int, c int>"
    df = spark.createDataFrame([("U", (1, 2), (None, 3)), ("D", (4, 5), None)], schema)

    def rows(policy):
        merged = cdc.merge_images(df, policy)
        assert merged.columns == ["a", "b", "c"]
        return [tuple(r) for r in merged.collect()]

    assert rows("after_wins") == [(None, 2, 3), (None, 5, None)]
    assert rows("coalesce") == [(1, 2, 3), (4, 5, None)]
    assert rows("by_op") == [(None, 2, 3), (4, 5, None)]
    with pytest.raises(ValueError):
        cdc.merge_images(df, "other")


def test_unknown_operations_are_kept_apart(spark):
    df = spark.createDataFrame([("c",), ("I",), ("?",), (None,)], "op_type string")
    known, unknown = cdc.normalise_operations(df)
    assert [r[0] for r in known.collect()] == ["I", "I"]
    assert sorted(str(r[0]) for r in unknown.collect()) == ["?", "None"]


def test_tombstones_pass_through(spark):
    df = spark.createDataFrame([("U", (1,), (2,)), (None, None, None)], "op_type string, before struct<a int>, after struct<a int>")
    events, tombstones = cdc.split_tombstones(df)
    assert events.count() == 1 and tombstones.count() == 1


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-08-08T07:39:21.253742+07:00", dt.datetime(2025, 8, 8, 7, 39, 21, 253000)),
        ("2025-08-08T07:39:21Z", dt.datetime(2025, 8, 8, 7, 39, 21)),
        ("2025-08-08T07:39-03:30", dt.datetime(2025, 8, 8, 7, 39)),
        ("1960-01-01T00:00:00.9999+00:00", dt.datetime(1960, 1, 1, 0, 0, 0, 999000)),
        (None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_wall_clock(spark, text, expected, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(clock.wall_clock(F.col("t")).alias("t")).first()["t"] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("text", ["2025-08-08T07:39:21.253742", "not a date", "", "2025-13-08T07:39:21Z"])
def test_wall_clock_refuses(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(clock.wall_clock(F.col("t")))
    with pytest.raises(PySparkException):
        df.collect()


def test_wall_clock_in_a_spring_gap(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2025-03-09T02:30:00.5+07:00",)], "t string")
        value = df.select(clock.wall_clock(F.col("t")).alias("t")).first()["t"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert value == dt.datetime(2025, 3, 9, 2, 30, 0, 500000)


def test_wall_clock_at_any_depth(spark):
    stamp = "2025-08-08T07:39:21.253742+07:00"
    wall = dt.datetime(2025, 8, 8, 7, 39, 21, 253000)
    schema = "t string, s struct<t string, x int>, a array<struct<t string>>, m map<string, struct<t string>>, l array<string>"
    df = spark.createDataFrame(
        [(stamp, (stamp, 1), [(stamp,), (None,)], {"k": (stamp,)}, [stamp]), (None, None, None, None, None)], schema
    )
    df = nested.tag_zoned(df, ["t"])
    done = nested.convert_wall_clock(df, ["s.t", "a[].t", "m[].t", "l[]"])
    first, second = done.collect()
    assert first["t"] == wall and first["s"]["t"] == wall and first["s"]["x"] == 1
    assert [x["t"] for x in first["a"]] == [wall, None]
    assert first["m"]["k"]["t"] == wall and first["l"] == [wall]
    assert all(v is None for v in second)
    assert done.schema["t"].metadata == {}
    assert nested.convert_wall_clock(df, ["s.t"], enabled=False).schema == df.schema


def test_wall_clock_leaves_timestamps_and_metadata(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1), "x")], "t timestamp_ntz, v string")
    df = df.withMetadata("v", {"doc": "kept"})
    done = nested.convert_wall_clock(df, ["t"])
    assert done.schema["t"].dataType == T.TimestampNTZType()
    assert done.schema["v"].metadata == {"doc": "kept"}


def test_typed_json_sample(spark):
    text = (
        '{"table":{"string":"LOGMINER.CUSTOMER_INFORMATION"},"op_type":{"string":"R"},'
        '"op_ts":{"string":"2025-08-19 10:29:25.3284886"},"current_ts":{"string":"2025-08-19 10:59:53.981000"},'
        '"pos":{"string":"000000000000018635"},"after":{"row":{"CUSTOMER_ID":{"string":"cbebf044"},'
        '"ACCOUNT_BALANCE":{"double":563511.18},"RISK_SCORE":{"long":3},"CITY":null}}}'
    )
    fields = {"CUSTOMER_ID": "string", "ACCOUNT_BALANCE": "double", "RISK_SCORE": "long", "CITY": "string", "STATE": "string"}
    df = spark.createDataFrame([(text,)], "t string")
    event = cdc.decode_typed_json(df, "t", fields).withColumn("at", clock.event_ts(F.col("event.op_ts"))).first()
    assert event["at"] == dt.datetime(2025, 8, 19, 10, 29, 25, 328488)
    assert event["event"]["op_type"] == "R" and event["event"]["before"] is None
    assert not event["event"]["malformed"]
    bad = spark.createDataFrame([("{oops",), ('{"table": 5}',), (None,)], "t string")
    flags = cdc.decode_typed_json(bad, "t", fields).select("event.malformed", "event.after").collect()
    assert [tuple(r) for r in flags] == [(True, None), (True, None), (False, None)]
    assert event["event"]["after"].asDict() == {
        "CUSTOMER_ID": "cbebf044", "ACCOUNT_BALANCE": 563511.18, "RISK_SCORE": 3, "CITY": None, "STATE": None}


def test_schema_changes(spark):
    old = T._parse_datatype_string("a int, b string, c date")
    new = T._parse_datatype_string("a long, c date, d string")
    changes = cdc.schema_changes(spark, "t", old, new)
    assert {(r["column_name"], r["change"], r["old_type"], r["new_type"]) for r in changes.collect()} == {
        ("a", "retyped", "int", "bigint"), ("b", "removed", "string", None), ("d", "added", None, "string")}
    log = cdc.log_schema_change(changes, dt.datetime(2025, 1, 2))
    signal = cdc.snapshot_signals(log, dt.date(2025, 1, 2)).first()
    assert tuple(signal) == ("t_snap_20250102", "execute-snapshot", '{"data-collections":["dbo.t"]}')
    assert cdc.snapshot_signals(cdc.mark_processed(log), dt.date(2025, 1, 2)).isEmpty()
    assert cdc.schema_changes(spark, "t", old, old).isEmpty()


def test_field_union_keeps_order():
    a, b = T._parse_datatype_string("x int, y int"), T._parse_datatype_string("z int, y int")
    assert cdc.field_union(a, b) == ["x", "y", "z"]


def test_late_older_event_does_not_revive(spark):
    schema = "id int, v string, pos long, op string"
    state = spark.createDataFrame([(1, None, 9, "D"), (2, "kept", 5, "U")], schema)
    late = spark.createDataFrame([(1, "late", 3, "U"), (2, "older", 4, "U"), (3, "new", 1, "I")], schema)
    merged = cdc.merge_with_markers(state, late, "id", "pos")
    assert sorted(tuple(r) for r in cdc.live_rows(merged).collect()) == [(2, "kept", 5, "U"), (3, "new", 1, "I")]


def test_only_d_deletes(spark):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    log = spark.createDataFrame([(1, "x", 1, None), (2, "y", 1, "D"), (4, "z", 1, "I")], "id int, v string, pos int, op string")
    rows = sorted(tuple(r) for r in cdc.apply_changes(table, log, "id", "pos").collect())
    assert rows == [(1, "x"), (3, "c"), (4, "z")]


def test_position_is_numeric(spark):
    df = spark.createDataFrame([("9",), ("10",), ("20000000000000000010",)], "pos string")
    ordered = df.orderBy(cdc.position_number(F.col("pos")).desc()).collect()
    assert [r[0] for r in ordered] == ["20000000000000000010", "10", "9"]


def test_codes(spark):
    df = spark.createDataFrame([("up_for_retry",), ("skipped",), ("running",), (None,), ("odd",)], "s string")
    rows = df.select(
        codes.task_status_code(F.col("s")).alias("t"), codes.run_status_code(F.col("s")).alias("r"),
        codes.status_text(F.col("s")).alias("x")).collect()
    assert [tuple(r) for r in rows] == [
        (3, 0, "up_for_retry"), (5, 0, "skipped"), (4, 3, "Running"), (0, 0, "No Status"), (0, 0, "odd")]


def test_missing_field_is_reported(spark):
    df = spark.createDataFrame([("U", (1,), (2,))], "op_type string, before struct<a int>, after struct<a int>")
    with pytest.raises(ValueError):
        cdc.final_values(df, ["nope"])
    with pytest.raises(AnalysisException):
        cdc.final_values_for(df, "U", ["nope"]).collect()
