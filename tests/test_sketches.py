import datetime as dt
import random

from pyspark.sql import functions as F

from tidewell.operators import metrics

SCHEMA = "ts timestamp_ntz, kind string, label string, host string, value double, who long"
BASE = dt.datetime(2024, 1, 1)


def samples(spark):
    rng = random.Random(3)
    rows = [
        (BASE + dt.timedelta(minutes=rng.randrange(4000)), kind, rng.choice("ab"), rng.choice("xyz"), rng.gauss(50, 9), rng.randrange(900))
        for kind in ("observer", "counter", "gauge") for _ in range(5000)
    ]
    rows.append((BASE, "observer", "empty", "x", None, None))
    return spark.createDataFrame(rows, SCHEMA).cache()


def test_merged_sketches_stay_near_the_samples(spark, tmp_path):
    rows = samples(spark)
    metrics.sketched_roll_up(rows, ["label", "host"], "1 hour", "who").write.parquet(str(tmp_path / "hours"))
    hours = spark.read.parquet(str(tmp_path / "hours"))
    # Hours to half days to days, and hours to days at once, over fewer labels.
    halves = metrics.merged_roll_up(hours, ["label"], "12 hours")
    for days in (metrics.merged_roll_up(halves, "label"), metrics.merged_roll_up(hours, "label")):
        got = {(r["bucket"], r["label"]): r for r in metrics.read_roll_up(days).where("kind = 'observer'").collect()}
        day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("bucket")
        exact = rows.where("kind = 'observer'").groupBy(day, "label").agg(
            F.count("value").alias("n"), F.sum("value").alias("total"), F.sort_array(F.collect_list("value")).alias("v"),
            F.count_distinct("who").alias("who"), F.min("value").alias("low"))
        for r in exact.collect():
            found = got[r["bucket"], r["label"]]
            assert (found["timer_count"], found["timer_min"]) == (r["n"], r["low"])
            if not r["n"]:
                assert found["timer_p50"] is None and found["timer_mean"] is None
                continue
            assert abs(found["timer_sum"] - r["total"]) < 1e-6 and abs(found["distinct"] - r["who"]) <= 0.05 * r["who"]
            for q in (50, 99):
                rank = sum(v <= found[f"timer_p{q}"] for v in r["v"]) / r["n"]
                assert abs(rank - q / 100) < 0.02


def test_other_kinds_and_all_labels(spark):
    rows = samples(spark)
    hours = metrics.sketched_roll_up(rows, ["label", "host"], "1 hour")
    total = metrics.read_roll_up(metrics.merged_roll_up(hours, [], "10 days"))
    found = {r["kind"]: r for r in total.collect()}
    exact = rows.where("kind = 'counter'").agg(F.sum("value")).first()[0]
    last = rows.where("kind = 'gauge'").agg(F.max(F.struct("ts", "value"))).first()[0]["value"]
    assert abs(found["counter"]["counter_sum"] - exact) < 1e-6 and found["gauge"]["gauge_last"] == last
    assert "distinct" not in total.columns and found["counter"]["timer_p50"] is None
    assert metrics.read_roll_up(metrics.merged_roll_up(metrics.sketched_roll_up(rows.limit(0), "label"), "label")).isEmpty()
