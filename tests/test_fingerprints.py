import re

import pytest
from pyspark.sql import functions as F

from tidewell.operators import fingerprints as fp
from tidewell.operators import keyed

SCHEMA = "k long, v string, w int"


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def sides(spark):
    a = spark.range(5000).select(
        F.when(F.col("id") % 500 == 7, None).otherwise(F.col("id")).alias("k"), F.concat(F.lit("v"), F.col("id") % 13).alias("v"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 11).cast("int").alias("w"))
    b = a.where("k IS NULL OR k NOT BETWEEN 40 AND 42").withColumn("v", F.when(F.col("k") == 3333, "other").otherwise(F.col("v")))
    return a, b.unionByName(a.where("k = 4001")).unionByName(a.where("k IS NULL").limit(1))


@pytest.mark.parametrize("fan,leaf", [(4, 50), (16, 5), (256, 10**6), (2, 1)])
def test_equals_the_whole_comparison(spark, sides, fan, leaf):
    a, b = sides
    found = fp.compare_by_ranges(a, b, "k", fan, leaf)
    assert rows(found.rows) == rows(keyed.differing_rows(a, b)) and len(found.levels) <= 4
    # Each level reads what the one before found to differ, and no more.
    read = [n for _, _, n in found.levels]
    assert read == sorted(read, reverse=True) and read[-1] < 10_000


def test_equal_tables_and_empty_ones(spark, sides):
    a, _ = sides
    same = fp.compare_by_ranges(a, a.repartition(7).orderBy("v"), "k")
    assert same.ranges == [] and same.rows.isEmpty() and same.levels == [(len(same.cuts) + 1, 0, 0)]
    none = a.limit(0)
    assert fp.compare_by_ranges(none, none, "k").rows.isEmpty()
    assert fp.compare_by_ranges(none, a, "k", 8, 100).rows.count() == keyed.differing_rows(none, a).count()


def test_nulls_are_told_apart_by_column(spark):
    a = spark.createDataFrame([(1, "x", None)], SCHEMA).select("k", "v", F.col("w").cast("string").alias("w"))
    b = spark.createDataFrame([(1, None, None)], SCHEMA).select("k", "v", F.lit("x").alias("w"))
    assert fp.compare_by_ranges(a, b, "k").rows.count() == 2


def test_a_hot_key_and_text_keys(spark):
    a = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("k%05d", "id")).alias("k"), (F.col("id") % 5).alias("v"))
    b = a.withColumn("v", F.when(F.col("k") == "k00100", 99).otherwise(F.col("v"))).unionByName(a.where("k = 'hot'").limit(3))
    found = fp.compare_by_ranges(a, b, "k", 8, 20)
    assert rows(found.rows) == rows(keyed.differing_rows(a, b))


def test_only_differing_ranges_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10_000).selectExpr("id k", "id * 2 v").repartitionByRange(8, "k").write.parquet(path)
    a = spark.read.parquet(path)
    b = a.withColumn("v", F.when(F.col("k") == 6000, F.lit(0).cast("long")).otherwise(F.col("v")))
    found = fp.compare_by_ranges(a, b, "k", 16, 100)
    text = found.rows._jdf.queryExecution().executedPlan().toString()
    low, high = (int(re.search(p, text)[1]) for p in (r"GreaterThan\(k,(\d+)\)", r"LessThanOrEqual\(k,(\d+)\)"))
    assert 0 < 6000 - low <= 100 and 0 <= high - 6000 <= 100
    assert [r["k"] for r in found.rows.collect()] == [6000, 6000]


def test_stored_prints_compare_without_the_tables(spark, sides, tmp_path):
    a, b = sides
    cuts = [1000, 2000, 3000, 4000]
    prints = []
    for name, side in (("a", a), ("b", b)):
        fp.fingerprints(side, "k", cuts).write.parquet(str(tmp_path / name))
        prints.append(spark.read.parquet(str(tmp_path / name)))
    found = {r["range"]: r["rows_a"] - r["rows_b"] for r in fp.differing_ranges(*prints).collect()}
    assert found == {-1: -1, 0: 3, 3: 0, 4: -1}
    up = {r["range"] for r in fp.differing_ranges(*(fp.rolled_up(p, 2) for p in prints)).collect()}
    assert up == {-1, 0, 1, 2}
    assert rows(fp.rolled_up(prints[0], 10).select("range", "rows")) == [(-1, 10), (0, 4990)]


def test_unlike_tables_are_refused(spark, sides):
    with pytest.raises(ValueError):
        fp.compare_by_ranges(sides[0], sides[0].drop("w"), "k")


def test_descent_ends_where_differences_lie_everywhere(spark):
    a = spark.range(4000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    b = a.withColumn("v", F.when(F.col("k") % 10 == 3, "w").otherwise(F.col("v")))
    found = fp.compare_by_ranges(a, b, "k", 4, 5)
    assert len(found.levels) == 2 and rows(found.rows) == rows(keyed.differing_rows(a, b)) and found.rows.count() == 800
