import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import schema_versions as sv


def ddl(text):
    return T.StructType.fromDDL(text)


def kind(text):
    return ddl(f"x {text}")["x"].dataType


@pytest.mark.parametrize("a,b,want", [
    ("int", "int", "int"), ("tinyint", "bigint", "bigint"), ("int", "decimal(12,2)", "decimal(12,2)"),
    ("bigint", "decimal(12,4)", "decimal(24,4)"), ("decimal(38,0)", "decimal(10,9)", "string"), ("int", "double", "double"),
    ("bigint", "double", "string"), ("decimal(5,2)", "double", "string"), ("float", "double", "double"), ("date", "timestamp", "timestamp"),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("int", "string", "string"), ("boolean", "int", "string"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,double>", "map<string,double>"),
    ("struct<a:int>", "struct<b:string,a:bigint>", "struct<a:bigint,b:string>"),
])
def test_promotion_is_a_join(a, b, want):
    assert sv.promoted(kind(a), kind(b)) == sv.promoted(kind(b), kind(a)) or "struct" in a
    assert sv.promoted(kind(a), kind(b)).simpleString() == kind(want).simpleString()
    assert sv.promoted(sv.promoted(kind(a), kind(b)), kind(a)).simpleString() == kind(want).simpleString()


def test_unlike_kinds_have_no_common_type():
    with pytest.raises(ValueError):
        sv.promoted(kind("array<int>"), kind("int"))
    with pytest.raises(ValueError):
        sv.promoted(kind("binary"), kind("string"))


LOG = [(10, "id int, v int"), (20, "id int, v bigint, s struct<a:int>"), (20, "id int"), (30, "id int, v bigint, s struct<a:int>"),
       (40, "id int, v decimal(6,2), s struct<a:bigint,b:string>"), (None, "id string")]


@pytest.fixture(scope="module")
def versions(spark):
    return sv.versions_of(spark.createDataFrame(LOG, "position long, schema string"))


def test_versions_of_a_log(spark, versions):
    assert versions.begins == (10, 20, 40)
    assert versions.target.simpleString() == "struct<id:int,v:decimal(22,2),s:struct<a:bigint,b:string>>"
    at = spark.createDataFrame([(p,) for p in (9, 10, 19, 20, 39, 40, 99, None)], "p long")
    assert [r[0] for r in at.select(versions.in_force(F.col("p"))).collect()] == [0, 1, 1, 2, 2, 3, 3, None]
    steps = {(r["version"], r["begins"], r["column_name"], r["change"]) for r in versions.changes(spark, "t").collect()}
    assert steps == {(2, 20, "v", "retyped"), (2, 20, "s", "added"), (3, 40, "v", "retyped"), (3, 40, "s", "retyped")}
    with pytest.raises(ValueError):
        sv.versions_of(spark.createDataFrame([], "position long, schema string"))


EVENTS = [
    (11, 1, "U", '{"id":1,"v":7}'), (12, 2, "U", '{"id":2,"v":"x"}'), (21, 3, "U", '{"id":3,"v":8000000000,"s":{"a":5}}'),
    (41, 1, "U", '{"id":1,"v":1.25,"s":{"a":6,"b":"q"}}'), (42, 4, "U", "no json"), (43, 3, "D", None), (5, 9, "U", '{"id":9}'),
    (44, 5, "U", '{"id":5,"more":1}'),
]


def test_events_are_decoded_by_the_version_in_force(spark, versions):
    events = spark.createDataFrame(EVENTS, "pos long, key int, op string, payload string")
    got = {r["pos"]: r for r in sv.decode_by_version(events, versions, "payload", "pos").collect()}
    assert {p for p, r in got.items() if r["malformed"]} == {12, 42, 5}
    assert (float(got[11]["v"]), got[11]["s"], got[11]["version"]) == (7.0, None, 1)
    assert (int(got[21]["v"]), got[21]["s"].asDict()) == (8000000000, {"a": 5, "b": None})
    assert (float(got[41]["v"]), got[41]["s"].asDict()) == (1.25, {"a": 6, "b": "q"})
    assert got[43]["id"] is None and not got[43]["malformed"] and got[44]["id"] == 5


def test_a_log_of_three_versions_is_applied(spark, versions):
    table = spark.createDataFrame([(3, 1.5, "old"), (7, 2.5, None)], "id int, v double, note string")
    events = spark.createDataFrame(EVENTS, "pos long, id int, op string, payload string")
    out = sv.apply_versioned(table, events, versions, "id", "payload", "pos")
    # Doubles and decimals meet in text only.
    assert out.schema.simpleString() == "struct<id:int,v:string,note:string,s:struct<a:bigint,b:string>>"
    got = {r["id"]: r for r in out.collect()}
    assert set(got) == {1, 5, 7} and got[1]["v"] == "1.25" and got[7]["v"] == "2.5" and got[5]["v"] is None
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_a_payload_is_parsed_once_for_all_fields(spark, versions):
    events = spark.createDataFrame([(11, 1, "U", '{"id":1,"v":7}'), (5, 9, "U", '{"id":9}'), (43, 3, "D", None)], "pos long, k int, op string, payload string")
    decoded = sv.decode_by_version(events, versions, "payload", "pos").where("NOT malformed")
    assert sorted(r["pos"] for r in decoded.collect()) == [11, 43]
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == len(versions.schemas)
