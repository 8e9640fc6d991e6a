import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import draws
from tidewell.operators import synth, workload
from tidewell.operators.table_specs import SPECS


@pytest.mark.parametrize("table", sorted(SPECS))
def test_rows_do_not_depend_on_partitions(spark, table):
    one = synth.generate(spark, SPECS[table], 60, seed=5, partitions=1)
    many = synth.generate(spark, SPECS[table], 60, seed=5, partitions=7)
    assert one.columns == [c[0] for c in SPECS[table]]
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))
    other = synth.generate(spark, SPECS[table], 60, seed=6)
    assert sorted(map(repr, one.collect())) != sorted(map(repr, other.collect()))


def test_start_goes_on_from_earlier_files(spark):
    whole = synth.generate(spark, SPECS["customer_information_small"], 30)
    parts = synth.generate(spark, SPECS["customer_information_small"], 10).unionByName(
        synth.generate(spark, SPECS["customer_information_small"], 20, start=11))
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, parts.collect()))


def test_types(spark):
    schema = synth.generate(spark, SPECS["stock_transactions"], 1).schema
    assert isinstance(schema["transaction_id"].dataType, T.LongType)
    assert isinstance(schema["trade_timestamp"].dataType, T.TimestampNTZType)
    assert schema["exchange_rate"].dataType == T.DecimalType(18, 4)


def test_bounds_are_reached_and_kept(spark):
    key = F.col("id")
    row = spark.range(20000).select(
        draws.whole(draws.draw("a", key), 3, 6).alias("w"), draws.number(draws.draw("b", key), 0.1, 0.5, 1).alias("n"),
        draws.unit(draws.draw("c", key)).alias("u"), draws.digits(draws.draw("d", key), 3).alias("d"),
    ).agg(F.min("w"), F.max("w"), F.min("n").cast("string"), F.max("n").cast("string"), F.min("u") >= 0, F.max("u") < 1,
          F.avg("u").between(0.48, 0.52), F.min(F.length("d")), F.max(F.length("d"))).first()
    assert tuple(row) == (3, 6, "0.1", "0.5", True, True, True, 3, 3)


def test_unique_numbers(spark):
    n = spark.range(1000).select(draws.unique_number(F.col("id"), 100, 1000, 7).alias("n"))
    row = n.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(row) == (1000, 100, 1099)
    with pytest.raises(ValueError):
        draws.unique_number(F.col("id"), 0, 10, 5)


def test_document_spec(spark):
    document = {"tables": [{"table_name": "t", "row_count": 4, "columns": [
        {"column_name": "id", "kind": "sequence"}, {"column_name": "c", "kind": "choice", "args": ["x", "y"]},
        {"column_name": "m", "kind": "moment", "args": [-1, 0]}, {"column_name": "later", "kind": "days_after", "args": ["m", 2, 2]}]}]}
    spec, rows = synth.spec_from_document(document, "t")
    got = synth.generate(spark, spec, rows, as_of=dt.datetime(2025, 1, 1)).collect()
    assert [r["id"] for r in got] == [1, 2, 3, 4]
    assert all(r["later"] - r["m"] == dt.timedelta(days=2) for r in got)
    with pytest.raises(KeyError):
        synth.spec_from_document(document, "u")
    with pytest.raises(ValueError):
        synth.generate(spark, [("x", "odd")], 1)


def test_workload_overlap_and_log(spark):
    table = spark.range(50).select("id", F.lit("old").alias("phone"))
    events = workload.change_events(
        table, "id", {"phone": workload.random_phone(F.col("id"))}, **workload.SMALL, pick="first")
    rows = events.collect()
    deletes = {r["id"]: r["before"]["phone"] for r in rows if r["op_type"] == "D"}
    updates = {r["id"]: r["after"]["phone"] for r in rows if r["op_type"] == "U"}
    assert sorted(updates) == list(range(10)) and sorted(deletes) == [0, 1]
    assert deletes == {k: updates[k] for k in deletes}
    assert sorted(r["batch"] for r in rows) == list(range(12))
    lines = [r["line"] for r in workload.log_lines(events, "id", ["phone"]).collect()]
    assert sum(l.startswith("[UPDATE] id=") and " | phone=09" in l for l in lines) == 10
    assert "[DELETE] id=0" in lines
    again = workload.change_events(table.repartition(3), "id", {"phone": F.lit("x")}, 5, 2, 2, seed=9)
    once = workload.change_events(table, "id", {"phone": F.lit("x")}, 5, 2, 2, seed=9)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, once.collect()))


def test_keys_beyond_the_range_fail(spark):
    with pytest.raises(Exception, match="no unique number"):
        spark.range(11).select(draws.unique_number(F.col("id"), 0, 10, 7)).collect()


def test_ids_of_one_file_are_made_wide_by_many_tasks(spark):
    ids = spark.range(1000).coalesce(1)
    assert synth.spread(ids).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    few = synth.spread(ids, 20)
    assert few.rdd.getNumPartitions() == 50 and sorted(r["id"] for r in few.collect()) == list(range(1000))
