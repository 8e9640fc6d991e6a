import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.clock import duration_seconds, micros
from tidewell.operators import metrics, quality, reconcile
from tidewell.operators.metric_rules import METRIC_RULES


def test_suite(spark, tmp_path):
    df = spark.createDataFrame([(1, "Ann"), (1, "Bob 2"), (None, None), (3, "Cy")], "id int, name string")
    rules = [
        {"rule": "row_count", "above": 3},
        {"rule": "not_null", "column": "id"},
        {"rule": "not_null", "column": "id", "allowed": 1},
        {"rule": "matches", "column": "name", "pattern": r"^[A-Za-z\s]+$"},
        {"rule": "unique", "column": "id"},
        {"rule": "duplicate_count", "column": "id"},
        {"rule": "schema", "column": "id", "type": "integer"},
        {"rule": "schema", "column": "gone", "type": "string"},
        *quality.length_rules(df.schema, {"name": 3}),
    ]
    quality.save_suite(spark, rules, str(tmp_path / "suite"))
    assert quality.load_suite(spark, str(tmp_path / "suite")) == rules
    result = [(r["rule"], r["observed"], r["passed"]) for r in quality.run_suite(df, rules).collect()]
    assert sorted(result) == sorted([
        ("row_count", 4, True), ("not_null", 1, False), ("not_null", 1, True), ("matches", 1, False),
        ("unique", 2, False), ("duplicate_count", 1, False), ("schema", 0, True), ("schema", 1, False),
        ("max_length", 1, False)])
    with pytest.raises(ValueError):
        quality.run_suite(df, [{"rule": "odd", "column": "id"}])


def test_suite_on_one_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "2025-07-10"), (2, "2025-07-11")], "id int, date string").write.partitionBy("date").parquet(path)
    rows = quality.run_suite_on(spark, path, "date", "2025-07-10", [{"rule": "row_count", "above": 0}]).collect()
    assert [(r["observed"], r["passed"]) for r in rows] == [(1, True)]


def test_empty_table_has_no_nulls(spark):
    df = spark.createDataFrame([], "a int, b date")
    assert sorted(r[0] for r in quality.columns_without_nulls(df).collect()) == ["a", "b"]
    assert [r[0] for r in quality.columns_without_nulls(df, (T.DateType,)).collect()] == ["b"]


def test_all_null_unique_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a int")
    assert tuple(quality.duplicate_stats(df, "a").first()) == (0, 0)


def test_count_difference_with_null_keys(spark):
    a = spark.createDataFrame([("x",), ("x",), (None,)], "k string")
    b = spark.createDataFrame([("x",), ("y",)], "k string")
    rows = {r["k"]: (r["source"], r["target"], r["diff"]) for r in reconcile.count_difference(a, b, "k").collect()}
    assert rows == {"x": (2, 1, 1), "y": (0, 1, -1), None: (1, 0, 1)}


def test_every_rule_is_reached(spark):
    names = {
        r["name"]: r["match"].replace(r"(.+)\.(.+)_", "e.j_").replace(r"(.+)\.", "e.").replace("(.+)", "op").replace("$", "").replace("*", "p")
        for r in METRIC_RULES
    }
    df = spark.createDataFrame(list(names.items()), "wanted string, name string")
    rows = metrics.map_metric_names(df).collect()
    assert len(rows) == 46
    for r in rows:
        assert r["metric"] == r["wanted"]
        rule = next(x for x in METRIC_RULES if x["name"] == r["metric"])
        assert r["kind"] == rule["kind"] and set(r["labels"]) == set(rule["labels"])


def test_rule_order_and_captures(spark):
    df = spark.createDataFrame(
        [("env.ti.finish.dagA.taskB.success",), ("env.ti.start.dagA.my_start",), ("odd",), ("a.b.c.job_end",), (None,)], "name string")
    rows = {r["name"]: (r["metric"], r["labels"]) for r in metrics.map_metric_names(df).collect()}
    assert rows["env.ti.finish.dagA.taskB.success"] == (
        "af_agg_ti_finish", {"instance": "env", "dag_id": "dagA", "task_id": "taskB", "state": "success"})
    assert rows["env.ti.start.dagA.my_start"] == (
        "af_agg_job_start", {"instance": "env.ti.start.dagA", "job_name": "my"})
    assert rows["a.b.c.job_end"] == ("af_agg_job_end", {"instance": "a.b.c", "job_name": "job"})
    assert rows["odd"] == (None, None) and rows[None] == (None, None)
    globs = {r["name"]: r["metric"] for r in metrics.map_metric_names(df, precedence="glob").collect()}
    assert globs["env.ti.start.dagA.my_start"] == "af_agg_ti_start"


def test_own_rules_with_literals_and_part_globs(spark):
    rules = [
        {"kind": "gauge", "match_type": "regex", "match": "^x[0-9]|y$", "name": "m1", "labels": {"fixed": "v"}},
        {"kind": "gauge", "match_type": "glob", "match": "a*c.*", "name": "m2", "labels": {"l": "$1"}},
    ]
    df = spark.createDataFrame([("x1",), ("zy",), ("abbc.q",), ("ac",)], "name string")
    rows = {r["name"]: (r["metric"], r["labels"]) for r in metrics.map_metric_names(df, rules).collect()}
    assert rows == {"x1": ("m1", {"fixed": "v"}), "zy": ("m1", {"fixed": "v"}), "abbc.q": ("m2", {"l": "q"}), "ac": (None, None)}


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    """A session zone; the samples below run over an hour that New York's clock skips."""
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_micros_and_durations_need_no_zone(spark, zone):
    rows = [(dt.datetime(2024, 3, 10, 1, 59, 59, 999999), dt.datetime(2024, 3, 10, 3)),
            (dt.datetime(1969, 12, 31, 23, 59, 59, 500000), dt.datetime(1970, 1, 2, 3, 4, 5, 6)), (None, dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(micros(F.col("a")), duration_seconds(F.col("a"), F.col("b"))).collect()
    epoch, us = dt.datetime(1970, 1, 1), dt.timedelta(microseconds=1)
    assert [tuple(r) for r in got] == [
        ((a - epoch) // us, (b - a) / dt.timedelta(seconds=1)) if a else (None, None) for a, b in rows]


@pytest.mark.parametrize("chunks", [None, 1, 2, 50, 500])
def test_intervals_do_not_depend_on_chunks(spark, zone, chunks):
    rng = random.Random(chunks)
    start = dt.datetime(2024, 3, 10, 1, 55)
    rows, expected = [], []
    for series in ("a", "b"):
        at, run = start, None
        for n in range(120):
            at += dt.timedelta(seconds=rng.choice([0, 1, 3, 40]))
            state = rng.choice(["x", "x", "x", "y", None])
            rows.append((series, at, n, state))
            if run is not None and run[1] == state:
                run[3], run[4] = at, run[4] + 1
            else:
                run = [series, state, at, at, 1]
                expected.append(run)
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, n int, status string")
    got = metrics.state_intervals(df, "series", "status", ["ts", "n"], chunks).collect()
    assert sorted(map(repr, (list(r) for r in got))) == sorted(map(repr, expected))


@pytest.mark.parametrize("kind", ["int", "string"])
def test_intervals_where_one_time_holds_most_samples(spark, kind):
    at = dt.datetime(2024, 1, 1)
    times = [at - dt.timedelta(seconds=1)] * 50 + [at] * 900 + [at + dt.timedelta(microseconds=1)] * 50
    rows = [("s", t, n, "x" if n // 7 % 2 else "y") for n, t in enumerate(times)]
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, n int, status string")
    df = df if kind == "int" else df.withColumn("n", F.format_string("%06d", "n"))  # text sorts like the numbers
    chunked = metrics._chunked(df, ["ts", "n"], 20)
    order = [r["_chunk"] for r in chunked.orderBy("n").collect()]
    assert order == sorted(order)
    assert max(r["count"] for r in chunked.groupBy("_chunk").count().collect()) <= (120 if kind == "int" else 200)
    got = metrics.state_intervals(df, "series", "status", ["ts", "n"], 20).collect()
    assert sum(r["samples"] for r in got) == 1000 and len(got) == 143
    assert {r["samples"] for r in got} == {7, 6}


def test_intervals_of_nothing(spark):
    df = spark.createDataFrame([], "series string, ts timestamp_ntz, status string")
    assert metrics.state_intervals(df, "series").count() == 0


def test_range_last(spark, zone):
    rng = random.Random(3)
    start = dt.datetime(2024, 3, 10, 1, 50)
    rows = [("s", start + dt.timedelta(seconds=rng.randrange(2000)), float(n)) for n in range(40)]
    rows.append(("s", start, 99.0))
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, value double")
    got = {r["ts"]: r["value"] for r in metrics.range_last(df, "series", 60, 300).collect()}
    expected = {}
    for k in range(0, 50):
        t = start + dt.timedelta(seconds=60 * k)
        seen = [(ts, v) for _, ts, v in rows if t - dt.timedelta(seconds=300) < ts <= t]
        if seen:
            expected[t] = max(seen)[1]
    assert got == expected
    with pytest.raises(ValueError):
        metrics.range_last(df, "series", 60, 100)


def test_missing_labels_are_empty(spark):
    df = spark.createDataFrame(
        [("m", {"dag_id": "a", "status": "ok"}), ("m", {"dag_id": "ab"}), ("n", {"status": "ok"})],
        "metric string, labels map<string,string>")
    assert metrics.select_samples(df, match={"dag_id": ".*"}).count() == 3
    assert metrics.select_samples(df, match={"dag_id": "a"}).count() == 1
    assert metrics.select_samples(df, "m", {"status": ""}).count() == 1
    assert metrics.select_samples(df, "m", {"status": "ok"}, {"dag_id": "a|b"}).count() == 1


def test_gauges_use_the_id_as_label(spark):
    runs = spark.createDataFrame(
        [("t1", "success", dt.datetime(2024, 1, 1)), ("t2", None, None), ("Task", "failed", dt.datetime(2024, 1, 1))],
        "task_id string, state string, end_date timestamp_ntz")
    rows = {r["id"]: r for r in metrics.status_gauges(runs, "task_id", "task", dt.datetime(2024, 2, 1)).collect()}
    assert rows["t1"]["labels"] == {"Task": "t1", "timestamps": "2024-01-01 00:00:00", "t1": "success"}
    assert rows["t2"]["status"] == "unknown" and rows["t2"]["value"] == 0 and rows["t2"]["ts"] == dt.datetime(2024, 2, 1)
    assert rows["Task"]["labels"]["Task"] == "failed"


def test_task_report_keeps_zero_durations(spark):
    at = dt.datetime(2024, 1, 1)
    runs = spark.createDataFrame(
        [("d", "r", "a", "ok", at, at), ("d", "r", "b", "ok", at, None), ("d", "q", "c", "ok", at, at)],
        "dag_id string, run_id string, task_id string, state string, start_date timestamp_ntz, end_date timestamp_ntz")
    assert {r["task_id"]: r["duration"] for r in metrics.task_report(runs, "d", "r").collect()} == {"a": 0.0, "b": None}


def test_roll_up_of_kinds(spark):
    at = dt.datetime(2024, 1, 1, 5, 30)
    rows = [(at, "counter", 2.0), (at, "counter", 3.0), (at, "gauge", 7.0), (at + dt.timedelta(minutes=1), "gauge", 1.0), (at, "observer", 4.0)]
    df = spark.createDataFrame([("l", *r) for r in rows], "label string, ts timestamp_ntz, kind string, value double")
    got = {r["kind"]: r for r in metrics.roll_up(df, "label").collect()}
    assert got["counter"]["counter_sum"] == 5.0 and got["counter"]["gauge_last"] is None
    assert got["gauge"]["gauge_last"] == 1.0
    assert (got["observer"]["timer_count"], got["observer"]["timer_sum"], got["observer"]["timer_p50"]) == (1, 4.0, 4.0)
    assert got["counter"]["bucket"] == dt.datetime(2024, 1, 1, 5)


def test_approximate_distinct(spark):
    df = spark.range(5000).select((F.col("id") % 500).alias("l"))
    assert 450 < metrics.distinct_series_approx(df, "l").first()["n"] < 550
