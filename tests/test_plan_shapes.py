"""What the physical plans must look like for the operators to hold at scale."""

import re

from pyspark.sql import functions as F

from tidewell.functions import clock
from tidewell.operators import cdc, keyed, metrics, nested, quality, reconcile, synth
from tidewell.operators.table_specs import SPECS
from tidewell.plans import cdc_plans, io_plans, metric_plans, synth_plans
from tidewell.sources import tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


def test_latest_row_is_cut_before_the_shuffle(spark):
    text = plan(keyed.latest_per_key(orders(spark), "o_custkey", "o_orderdate"))
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange hashpartitioning[\s\S]*WindowGroupLimit.*Partial", text)


def test_nested_fields_are_pruned(spark, tmp_path):
    path = str(tmp_path / "events")
    cdc_plans.order_events(spark, SF).write.parquet(path)
    text = plan(cdc.final_values(spark.read.parquet(path), ["o_orderstatus"]).select("o_orderstatus"))
    schema = re.search(r"ReadSchema: (\S+)", text)[1]
    assert "o_totalprice" not in schema and "csn" not in schema and "o_orderstatus" in schema


def test_wide_image_is_pruned(spark):
    ids = spark.range(10)
    text = plan(synth_plans.customer_events(ids).select("after.customer_code"))
    assert "custom_attr_040" not in text


def test_day_filter_reaches_the_scan(spark):
    text = plan(orders(spark).where(clock.on_day(F.col("o_orderdate"), "1995-03-15")).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_named_parameter_reaches_the_scan(spark):
    text = plan(io_plans.sql_over_files(spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text


def test_partition_filter_prunes_folders(spark):
    path = io_plans.orders_by_year(spark, SF)
    text = plan(tables.read_partition(spark, path, "year", "1995"))
    assert re.search(r"PartitionFilters: \[.*year", text)


def test_partitioned_write_is_rebalanced(spark):
    df = orders(spark).hint("rebalance", "o_orderstatus")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(df)


def test_quality_counts_share_one_scan(spark):
    rules = [{"rule": "row_count"}] + [{"rule": "not_null", "column": c} for c in orders(spark).columns]
    assert plan(quality.run_suite(orders(spark), rules)).count("FileScan") == 1
    assert plan(quality.null_profile(orders(spark))).count("FileScan") == 1


def test_uniqueness_reads_its_column_only(spark):
    text = plan(quality.duplicate_stats(orders(spark), "o_custkey"))
    assert re.search(r"ReadSchema: struct<o_custkey:bigint>", text)


def test_comparisons_are_one_shuffle_of_combined_rows(spark):
    text = plan(reconcile.count_difference(orders(spark), orders(spark), "o_orderstatus"))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text and "Join" not in text
    text = plan(keyed.unmatched_keys(orders(spark), orders(spark), "o_custkey"))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_bool_or" in text.replace("partial_max", "partial_bool_or")


def test_existence_side_is_combined(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.read.parquet(f"{SF}/lineitem.parquet")
        text = plan(keyed.absent_by_key(orders(spark), lines, "o_orderkey", "l_orderkey"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Keys are combined before their shuffle; the few that are left are exchanged once more for the
    # join, as AQE splits a hot key only between two exchanges that the join itself asked for.
    assert "LeftAnti" in text and text.count("Exchange hashpartitioning") == 3
    assert re.search(r"Exchange hashpartitioning\(_r0#\d+L, \d+\), ENSURE_REQUIREMENTS[\s\S]*_r0[\s\S]*Exchange hashpartitioning\(_r0", text)
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint>", text)


def test_no_cross_joins_and_no_python_rows(spark):
    samples = metric_plans.labelled(spark, SF)
    frames = [
        metrics.state_intervals(samples, "dag_id", "status", ["ts", "event_id"]),
        metrics.range_last(samples, "dag_id", 3600, 86400),
        metrics.map_metric_names(samples.withColumn("name", F.col("dag_id"))),
        metrics.run_table(samples, samples, "dag_id"),
        synth.generate(spark, SPECS["stock_transactions"], 10),
        nested.convert_wall_clock(orders(spark).select(F.struct(F.lit("x").alias("t")).alias("s")), ["s.t"]),
        cdc.apply_changes(
            orders(spark), orders(spark).withColumn("op", F.lit("U")), "o_orderkey", "o_orderdate"),
    ]
    for df in frames:
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
        assert "Python" not in text and "Pandas" not in text


def test_only_hot_keys_are_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(keyed.join_many_to_one(orders(spark), orders(spark).select("o_custkey"), "o_custkey"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [o_custkey" in text and text.count("LeftOuter, BuildRight") == 2


def test_intervals_shuffle_samples_once(spark):
    samples = spark.read.parquet(f"{SF}/events.parquet")
    text = plan(metrics.state_intervals(samples, "user_id", "event_type", ["ts", "event_id"]))
    by_chunk = re.findall(r"Exchange hashpartitioning\(user_id#\d+L?, _chunk", text)
    # Written once for the inner and once for the edge runs; the second is reused at run time.
    assert len(by_chunk) == 2


def test_only_wide_decimals_use_python(spark):
    df = spark.createDataFrame([(bytearray(b"\x01"),)], "raw binary")
    assert "ArrowEvalPython" in plan(df.select(nested.decode_wide_decimal(F.col("raw"), 0)))


def test_latest_row_reads_what_is_used_when_the_order_is_unique(spark):
    latest = keyed.latest_per_key(orders(spark), "o_custkey", "o_orderkey", unique_order=True)
    text = plan(latest.select("o_custkey", "o_orderkey"))
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>", text)


def test_state_is_read_whole_once(spark, tmp_path):
    state = orders(spark).select("o_orderkey", "o_orderdate", F.lit("U").alias("op"), "o_totalprice")
    path = str(tmp_path / "state")
    state.write.parquet(path)
    merged = cdc.merge_with_markers(spark.read.parquet(path), state, "o_orderkey", "o_orderdate")
    # A scan's location is cut short in the plan's text: the session is asked to keep it whole.
    limit = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    try:
        scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?" + re.escape("state") + r"\]", plan(merged))
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", limit)
    assert sum("o_totalprice" in columns for columns in scans) == 1
