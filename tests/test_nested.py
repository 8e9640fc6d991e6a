import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.functions.text import rename_by_pattern
from tidewell.operators import nested
from tidewell.sources import avro

SCHEMA = (
    "id long, s struct<a int, b struct<c string>>, arr array<int>, arr_s array<struct<x int>>, "
    "m1 map<string,int>, m2 map<string,int>"
)


def frame(spark):
    return spark.createDataFrame(
        [
            (1, (1, ("p",)), [1, 2], [(7,)], {"k1": 1}, {"j1": 5}),
            (2, (2, ("q",)), None, [(8,)], {"k2": 2}, {"j1": 6}),
            (3, (3, None), [], [(9,)], {"k1": 3}, None),
            (4, None, [4], [(10,), (11,)], {"k1": 4, "k2": 40}, {}),
        ],
        SCHEMA,
    )


def test_flatten_explode(spark):
    flat = nested.flatten(frame(spark), max_keys=100)
    assert flat.columns == ["id", "arr", "s_a", "arr_s_x", "k1", "k2", "j1", "s_b_c"]
    rows = {(r["id"], r["arr"], r["arr_s_x"], r["s_b_c"], r["k1"], r["k2"], r["j1"]) for r in flat.collect()}
    assert rows == {(1, 1, 7, "p", 1, None, 5), (1, 2, 7, "p", 1, None, 5),
                    (4, 4, 10, None, 4, 40, None), (4, 4, 11, None, 4, 40, None)}


def test_flatten_outer_keeps_rows(spark):
    flat = nested.flatten(frame(spark), mode="outer", max_keys=100)
    assert sorted({r["id"] for r in flat.collect()}) == [1, 2, 3, 4]


def test_flatten_maps_as_rows(spark):
    flat = nested.explode_maps(frame(spark).select("id", "m1", "m2"))
    rows = sorted(tuple(r) for r in flat.collect())
    assert rows == [(1, "k1", 1, "j1", 5), (2, "k2", 2, "j1", 6)]


def test_map_keys_are_limited_but_never_dropped(spark):
    df = spark.range(20).select("id", F.create_map(F.col("id").cast("string"), F.lit(1)).alias("m"))
    with pytest.raises(ValueError):
        nested.map_keys_as_columns(df, max_keys=10)
    assert len(nested.map_keys_as_columns(df, max_keys=20).columns) == 21
    assert nested.map_keys_as_columns(df, keys={"m": ["3"]}).columns == ["id", "3"]


def test_name_clash_is_an_error(spark):
    df = spark.createDataFrame([((1,), 2)], "s struct<a int>, s_a int")
    with pytest.raises(ValueError):
        nested.flatten_structs(df)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 99), st.lists(st.integers(0, 9), min_size=1, max_size=3)), min_size=1, max_size=6))
def test_flatten_keeps_leaves(spark, rows):
    data = [(i, (a, [(x,) for x in xs])) for i, (a, xs) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, s struct<a int, l array<struct<x int>>>")
    flat = nested.flatten(df, max_keys=100)
    expected = sorted((i, a, x) for i, (a, xs) in enumerate(rows) for x in xs)
    assert sorted((r["id"], r["s_a"], r["s_l_x"]) for r in flat.collect()) == expected


def decimal_type(precision, base="bytes"):
    kind = {"type": base, "logicalType": "decimal", "precision": precision, "scale": 2}
    return kind | ({"name": "f", "size": 20} if base == "fixed" else {})


def test_safe_reader_schema():
    schema = {
        "type": "record", "name": "r", "fields": [
            {"name": "ok", "type": decimal_type(38)},
            {"name": "wide", "type": decimal_type(39)},
            {"name": "fixed", "type": decimal_type(40, "fixed")},
            {"name": "union", "type": ["null", decimal_type(39)]},
            {"name": "array", "type": {"type": "array", "items": decimal_type(39)}},
            {"name": "map", "type": {"type": "map", "values": decimal_type(39)}},
            {"name": "nested", "type": {"type": "record", "name": "n", "fields": [{"name": "d", "type": decimal_type(39)}]}},
            {"name": "plain", "type": "string", "default": "x"},
        ]}
    safe = {f["name"]: f["type"] for f in avro.safe_reader_schema(schema)["fields"]}
    assert safe["ok"] == decimal_type(38)
    assert safe["wide"] == {"type": "bytes"}
    assert safe["fixed"] == {"type": "fixed", "name": "f", "size": 20}
    assert safe["union"] == ["null", {"type": "bytes"}]
    assert safe["array"]["items"] == {"type": "bytes"} and safe["map"]["values"] == {"type": "bytes"}
    assert safe["nested"]["fields"][0]["type"] == {"type": "bytes"}
    assert schema["fields"][1]["type"] == decimal_type(39)
    assert json.loads(avro.safe_reader_schema(json.dumps(schema))) == avro.safe_reader_schema(schema)


def zigzag(n):
    n, out = (n << 1) ^ (n >> 63), b""
    while n > 0x7F:
        out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
    return out + bytes([n])


def test_writer_schema_from_header(spark, tmp_path):
    schema = json.dumps({"type": "record", "name": "r", "fields": [{"name": "d", "type": decimal_type(50)}]})
    entries = b"".join(zigzag(len(x)) + x for x in (b"avro.codec", b"null", b"avro.schema", schema.encode()))
    (tmp_path / "a.avro").write_bytes(b"Obj\x01" + zigzag(2) + entries + zigzag(0) + b"s" * 16)
    assert avro.writer_schema(spark, str(tmp_path / "a.avro")) == schema
    other = schema.replace("\"d\"", "\"e\"").encode()
    entries = b"".join(zigzag(len(x)) + x for x in (b"avro.schema", other))
    (tmp_path / "b.avro").write_bytes(b"Obj\x01" + zigzag(1) + entries + zigzag(0) + b"s" * 16)
    with pytest.raises(ValueError, match="2 writer schemas"):
        avro.writer_schema(spark, str(tmp_path))
    with pytest.raises(ValueError):
        avro.header_schema(b"PAR1")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**60), 10**60), min_size=1, max_size=5), st.integers(0, 12))
def test_wide_decimals(spark, numbers, scale):
    rows = [(i, bytearray(n.to_bytes(32, "big", signed=True))) for i, n in enumerate(numbers)] + [(-1, None)]
    df = spark.createDataFrame(rows, "i int, raw binary")
    got = {r["i"]: r["v"] for r in df.select("i", nested.decode_wide_decimal(F.col("raw"), scale).alias("v")).collect()}
    assert got.pop(-1) is None
    for i, n in enumerate(numbers):
        digits = got[i].replace(".", "")
        assert int(digits) == n
        assert len(got[i].rpartition(".")[2]) == scale or scale == 0


def test_rename_by_pattern(spark):
    df = spark.createDataFrame([(1, 2)], "`Value #TOTAL_FAILED` int, other int")
    assert rename_by_pattern(df, r"^Value #([A-Z_]+)$", "$1").columns == ["TOTAL_FAILED", "other"]
    with pytest.raises(ValueError):
        rename_by_pattern(df.withColumnRenamed("other", "TOTAL_FAILED"), r"^Value #([A-Z_]+)$", "$1")
