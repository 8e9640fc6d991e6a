"""Source, sink and streaming queries. Each writes to a fresh folder of the shared folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewell.operators import cdc
from tidewell.plans.cdc_plans import order_events, user_change_log
from tidewell.plans.registry import load, query
from tidewell.session import scratch_path
from tidewell.sinks import files, lake
from tidewell.sources import tables
from tidewell.sources.stream import file_stream
from tidewell.streaming import events as streaming
from tidewell.streaming import intervals


def orders_by_year(spark, sf):
    """The orders as a folder partitioned by year."""
    path = scratch_path(spark, "orders_by_year")
    rows = load(spark, sf, "orders").withColumn("year", F.date_format("o_orderdate", "yyyy"))
    lake.write_table(rows, path, partition_by=["year"])
    return path


@query(
    "partition_prune",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1995",
)
def partition_prune(spark, sf):
    path = orders_by_year(spark, sf)
    return tables.read_partition(spark, path, "year", "1995").select("o_orderkey", "o_totalprice")


@query(
    "sql_over_files",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'",
)
def sql_over_files(spark, sf):
    rows = tables.sql_over_files(
        spark,
        f"{sf}/orders.parquet",
        "o_orderdate >= CAST(:since AS TIMESTAMP_NTZ)",
        since="1997-01-01",
    )
    return rows.select("o_orderkey", "o_custkey")


@query(
    "declared_catalog",
    """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS n FROM orders GROUP BY ALL
""",
)
def declared_catalog(spark, sf):
    entry = {
        "name": "orders_by_year",
        "dataPath": orders_by_year(spark, sf),
        "format": "parquet",
        "partitions": [{"name": "year", "type": "string"}],
    }
    registered = tables.register_catalog(spark, [entry])["orders_by_year"]
    return registered.groupBy("year").agg(F.count("*").alias("n"))


@query(
    "path_partition",
    "SELECT strftime(o_orderdate, '%Y') AS from_path, count(*) AS n FROM orders GROUP BY ALL",
)
def path_partition(spark, sf):
    df = spark.read.parquet(orders_by_year(spark, sf))
    tagged = tables.with_path_partition(df, r"year=([^/]*)/.*\.parquet", "from_path")
    return tagged.groupBy("from_path").agg(F.count("*").alias("n"))


@query(
    "read_or_empty",
    "SELECT count(*) AS n, 0::BIGINT AS missing FROM customer",
)
def read_or_empty(spark, sf):
    present = tables.read_or_empty(spark, f"{sf}/customer.parquet", "c_custkey long")
    absent = tables.read_or_empty(spark, f"{sf}/no_such_table.parquet", "c_custkey long")
    both = present.select("c_custkey", F.lit(1).alias("there")).unionByName(
        absent.select("c_custkey", F.lit(0).alias("there"))
    )
    return both.agg(F.sum("there").alias("n"), F.count_if(F.col("there") == 0).alias("missing"))


@query(
    "format_fallback",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
)
def format_fallback(spark, sf):
    return tables.read_table(spark, f"{sf}/supplier.parquet", formats=("hudi", "parquet"))


@query("csv_scan", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_scan(spark, sf):
    path = scratch_path(spark, "csv")
    rows = load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    rows.write.option("header", True).csv(path)
    return tables.read_csv(spark, path, rows.schema)


@query(
    "sequential_ids",
    """
SELECT count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders
WHERE o_orderkey BETWEEN 1 AND (SELECT count(*) FROM orders)
""",
)
def sequential_ids(spark, sf):
    """Generated ids 1..rows of the orders, matched with the order keys."""
    orders = load(spark, sf, "orders").select("o_orderkey")
    ids = tables.row_ids(spark, orders.count(), column="o_orderkey")
    return orders.join(ids, "o_orderkey", "left_semi").agg(
        F.count("*").alias("n"),
        F.min("o_orderkey").alias("low"),
        F.max("o_orderkey").alias("high"),
    )


@query(
    "manifest_summary",
    """
WITH m AS (SELECT n_chars, round(n_chars / 1048576, 2) AS mb FROM documents)
SELECT count(*) AS actual_file_count, sum(n_chars)::BIGINT AS total_size_bytes,
       round(sum(mb), 2) AS total_size_mb, round(avg(mb), 2) AS avg_file_size_mb,
       min(mb) AS min_file_size_mb, max(mb) AS max_file_size_mb FROM m
""",
)
def manifest_summary(spark, sf):
    """Documents stand in for files: their lengths are the sizes."""
    sizes = load(spark, sf, "documents").select(
        F.col("n_chars").alias("size_bytes"),
        files.megabytes(F.col("n_chars")).alias("size_mb"),
    )
    return files.manifest_summary(sizes)


@query(
    "sized_files",
    "SELECT 6 AS files, count(*) AS rows, 7::BIGINT AS manifest_columns FROM orders",
)
def sized_files(spark, sf):
    """Orders in six files, with a manifest beside them that the table scan passes over."""
    path = scratch_path(spark, "sized")
    orders = load(spark, sf, "orders")
    files.write_sized(orders, path, 6, orders.count())
    listed = files.manifest(spark, path, "parquet", dt.datetime(2025, 1, 1))
    manifest_path = files.write_manifest(listed, path)
    manifest = spark.read.json(manifest_path)
    rows = spark.read.parquet(path).agg(F.count("*").alias("rows"))
    return rows.select(
        F.lit(manifest.count()).cast("int").alias("files"),
        "rows",
        F.lit(len(manifest.columns)).cast("long").alias("manifest_columns"),
    )


@query("round_trip", "SELECT 0::BIGINT AS differing FROM region LIMIT 1")
def round_trip(spark, sf):
    """Lines written and read back hold the same rows, repeats included."""
    path = scratch_path(spark, "round_trip")
    differing = files.write_and_compare(load(spark, sf, "lineitem"), path)
    return differing.agg(F.count("*").alias("differing"))


@query(
    "versioned_overwrite",
    """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0
""",
)
def versioned_overwrite(spark, sf):
    """A table overwritten from itself without losing its files."""
    rows = load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    table = lake.VersionedTable(spark, scratch_path(spark, "versioned"), rows.schema)
    table.write(rows)
    table.write(table.read().where("c_acctbal > 0"))
    return table.read().drop("c_acctbal")


@query(
    "save_modes",
    """
SELECT 'append' AS mode, 2 * count(*) AS n FROM customer UNION ALL SELECT 'overwrite', count(*) FROM customer
UNION ALL SELECT 'ignore', count(*) FROM customer
""",
)
def save_modes(spark, sf):
    customers = load(spark, sf, "customer")
    counts = None
    for mode in ("append", "overwrite", "ignore"):
        path = scratch_path(spark, f"mode_{mode}")
        lake.write_table(customers, path)
        lake.write_table(customers, path, mode)
        part = spark.read.parquet(path).agg(F.count("*").alias("n")).select(F.lit(mode).alias("mode"), "n")
        counts = part if counts is None else counts.unionByName(part)
    return counts


STATE_SQL = """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
WHERE r = 1 AND event_type <> 'error'
"""


def event_files(spark, sf):
    """The change log as several files that arrive one by one."""
    path = scratch_path(spark, "event_files")
    log = user_change_log(spark, sf)
    log.repartition(4, "event_id").write.parquet(path)
    return path, log.schema


@query("stream_apply_changes", STATE_SQL)
def stream_apply_changes(spark, sf):
    """Changes applied file by file, compacted midway, equal the batch result."""
    path, schema = event_files(spark, sf)
    out, checkpoint = streaming.new_paths(spark, "applied")
    table = lake.ChangeTable(spark, out, schema, "user_id", ["ts", "event_id"])
    stream = file_stream(spark, path, schema, files_per_trigger=1)
    streaming.apply_stream(stream, table, checkpoint)
    table.compact()
    return table.read()


@query(
    "stream_tumbling_rollup",
    """
SELECT date_trunc('hour', ts) AS bucket, event_type, count(*) AS n, round(sum(value), 4) AS total,
       max(value) AS greatest FROM events GROUP BY ALL
""",
)
def stream_tumbling_rollup(spark, sf):
    path, schema = event_files(spark, sf)
    out, checkpoint = streaming.new_paths(spark, "rollup")
    stream = streaming.event_time(file_stream(spark, path, schema, files_per_trigger=2), "ts")
    rolled = streaming.tumbling_roll_up(stream, "ts", "event_type", "1 hour", "60 days")
    streaming.updates_to_table(rolled, out, checkpoint)
    latest = streaming.latest_updates(spark, out, ["bucket", "event_type"])
    return latest.select(
        F.col("bucket").cast("timestamp_ntz").alias("bucket"),
        "event_type",
        "n",
        F.round("total", 4).alias("total"),
        "greatest",
    )


@query(
    "stream_drop_repeats",
    "SELECT event_type, count(*) AS n FROM events GROUP BY ALL",
)
def stream_drop_repeats(spark, sf):
    """Every event is delivered twice and kept once."""
    path = scratch_path(spark, "repeats")
    log = user_change_log(spark, sf)
    log.unionByName(log).repartition(4, "event_id").write.parquet(path)
    out, checkpoint = streaming.new_paths(spark, "deduplicated")
    stream = streaming.event_time(file_stream(spark, path, log.schema), "ts")
    once = streaming.drop_repeats(stream, ["user_id", "event_id"], "ts", "60 days")
    streaming.to_table(once, out, checkpoint)
    return spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "stream_decode",
    """
SELECT op_type, count(*) AS n, count(o_orderstatus) AS with_status, sum(o_orderkey)::BIGINT AS keys FROM (
  SELECT o_orderkey, o_orderstatus,
         CASE o_orderkey % 3 WHEN 1 THEN 'I' WHEN 2 THEN 'U' ELSE 'D' END AS op_type FROM orders)
GROUP BY ALL
""",
)
def stream_decode(spark, sf):
    """Order envelopes decoded on a stream."""
    path = scratch_path(spark, "envelopes")
    envelopes = order_events(spark, sf)
    envelopes.write.parquet(path)
    out, checkpoint = streaming.new_paths(spark, "decoded")
    decoded = streaming.decoded_events(file_stream(spark, path, envelopes.schema))
    streaming.to_table(decoded, out, checkpoint)
    return (
        spark.read.parquet(out)
        .groupBy("op_type")
        .agg(
            F.count("*").alias("n"),
            F.count("o_orderstatus").alias("with_status"),
            F.sum("o_orderkey").alias("keys"),
        )
    )


@query(
    "stream_id_mapping",
    """
SELECT count(DISTINCT user_id) AS rows, count(DISTINCT user_id) AS keys, count(DISTINCT user_id) AS uuids
FROM events
""",
)
def stream_id_mapping(spark, sf):
    """Each user gets one id although users come back in every file."""
    path, schema = event_files(spark, sf)
    out, checkpoint = streaming.new_paths(spark, "mapping")
    stream = file_stream(spark, path, schema, files_per_trigger=1)
    streaming.map_stream(stream, out, "user_id", "query-salt", checkpoint)
    return spark.read.parquet(out).agg(
        F.count("*").alias("rows"),
        F.count_distinct("user_id").alias("keys"),
        F.count_distinct("uuid").alias("uuids"),
    )


@query(
    "stream_sessions",
    """
WITH marked AS (
  SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked),
sessions AS (
  SELECT user_id, min(ts) AS start_ts, max(ts) + INTERVAL 6 HOUR AS end_ts, count(*) AS n
  FROM runs GROUP BY user_id, s)
SELECT user_id, start_ts, end_ts, n FROM sessions
WHERE end_ts <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
""",
)
def stream_sessions(spark, sf):
    """Sessions that the watermark has closed."""
    path, schema = event_files(spark, sf)
    out, checkpoint = streaming.new_paths(spark, "sessions")
    stream = streaming.event_time(file_stream(spark, path, schema), "ts")
    sessions = streaming.user_sessions(stream, "ts", "user_id", "6 hours", "1 hour")
    streaming.to_table(sessions, out, checkpoint)
    closed = spark.read.parquet(out)
    return closed.select(
        "user_id",
        F.col("start_ts").cast("timestamp_ntz").alias("start_ts"),
        F.col("end_ts").cast("timestamp_ntz").alias("end_ts"),
        "n",
    )


LATE = "make_dt_interval(0, 0, 0, event_id % 3600)"  # how much later than its time an event arrives


@query(
    "stream_state_intervals",
    """
WITH s AS (SELECT CAST(user_id % 8 AS INTEGER) AS series, ts, event_id, event_type FROM events),
marked AS (
  SELECT *, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS new
  FROM s WINDOW w AS (PARTITION BY series ORDER BY ts, event_id)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY series ORDER BY ts, event_id) AS run FROM marked)
SELECT series, event_type, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS samples
FROM runs GROUP BY series, event_type, run
""",
)
def stream_state_intervals(spark, sf):
    """Eight series that arrive up to an hour late, in four deliveries with a restart before each."""
    rows = streaming.event_time(load(spark, sf, "events"), "ts").select(
        (F.col("user_id") % 8).cast("int").alias("series"), "ts", "event_id", "event_type"
    )
    arrived = rows.withColumn("arrived", F.col("ts") + F.expr(LATE))
    ends = arrived.agg(F.min(F.unix_micros("arrived")).alias("a"), F.max(F.unix_micros("arrived")).alias("b")).first()
    part = F.floor((F.unix_micros("arrived") - ends["a"]) * 4 / (ends["b"] - ends["a"] + 1))
    folder = scratch_path(spark, "arrivals")
    out, checkpoint = streaming.new_paths(spark, "intervals")
    for k in range(4):
        arrived.where(part == k).select(*rows.columns).repartition(2).write.mode("append").parquet(folder)
        stream = file_stream(spark, folder, rows.schema)
        found = intervals.state_intervals(stream, "series", "event_type", "ts", "2 hours", "event_id")
        intervals.intervals_to_table(found, out, checkpoint)
    return intervals.intervals_so_far(spark, out, "series").select(
        "series", "event_type", F.col("start_ts").cast("timestamp_ntz").alias("start_ts"),
        F.col("end_ts").cast("timestamp_ntz").alias("end_ts"), "samples",
    )


@query(
    "target_sized_files",
    "SELECT count(*) AS rows, true AS within_target FROM lineitem",
)
def target_sized_files(spark, sf):
    """Lines in files of about one megabyte, sized from a measured row."""
    path = scratch_path(spark, "target")
    files.write_to_target_size(load(spark, sf, "lineitem"), path, target_mb=1)
    largest = tables.list_files(spark, path, ".parquet").agg(F.max("size_bytes")).first()[0]
    rows = spark.read.parquet(path).agg(F.count("*").alias("rows"))
    return rows.withColumn("within_target", F.lit(largest < 1.5 * 1024 * 1024))


@query(
    "small_files_packed",
    "SELECT count(*) AS rows, sum(l_orderkey)::BIGINT AS keys, true AS near_target FROM lineitem",
)
def small_files_packed(spark, sf):
    """Lines from many tasks: all files but one within a fifth of the target, small tables in one file."""
    path = scratch_path(spark, "packed_lines")
    rows = load(spark, sf, "lineitem")
    files.write_to_target_size(rows.repartition(24, "l_orderkey"), path, target_mb=0.25)
    sizes = [r["size_bytes"] / 2**18 for r in tables.list_files(spark, path, ".parquet").collect()]
    near = sum(0.8 <= s <= 1.2 for s in sizes) >= len(sizes) - 1
    return spark.read.parquet(path).agg(
        F.count("*").alias("rows"), F.sum("l_orderkey").alias("keys")
    ).withColumn("near_target", F.lit(near))


@query("metastore_table", "SELECT c_custkey, c_name FROM customer")
def metastore_table(spark, sf):
    """Customers written and registered, then read by name."""
    path = scratch_path(spark, "registered")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    lake.save_as_table(load(spark, sf, "customer").select("c_custkey", "c_name"), name, path)
    return spark.table(name)


@query(
    "bucketed_apply",
    """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL
SELECT o_custkey, max(o_orderstatus) FROM orders WHERE o_custkey IN (
  SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderpriority = '5-LOW') < 9)
GROUP BY o_custkey
""",
)
def bucketed_apply(spark, sf):
    """Changes applied to a table that is stored by key, which is therefore not shuffled."""
    path = scratch_path(spark, "bucketed")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    customers = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    lake.save_bucketed(customers, name, "c_custkey", 8, path=path)
    low = F.count_if(F.col("o_orderpriority") == "5-LOW")
    log = (
        load(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_orderstatus").alias("c_mktsegment"), F.when(low < 9, "U").otherwise("D").alias("op"))
    )
    return cdc.apply_changes(spark.table(name), log, "c_custkey", "op")


@query("indexed_lookup", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey = 77")
def indexed_lookup(spark, sf):
    """A point lookup in files ordered by the looked-up column."""
    path = scratch_path(spark, "indexed")
    lake.write_indexed(load(spark, sf, "orders"), path, "o_custkey", ["o_custkey"])
    return spark.read.parquet(path).where("o_custkey = 77").select("o_orderkey", "o_custkey")


@query("registered_partitions", "SELECT c_custkey, c_nationkey::VARCHAR AS c_nationkey FROM customer")
def registered_partitions(spark, sf):
    """A partitioned folder made known by name, with all its partitions."""
    path = scratch_path(spark, "registered")
    rows = load(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string"))
    lake.write_table(rows, path, partition_by=["c_nationkey"])
    name = path.rsplit("/", 1)[1].replace("-", "_")
    lake.register_table(spark, name, path)
    return spark.table(name).select("c_custkey", F.col("c_nationkey").cast("string"))


@query("stream_two_checkpoints", STATE_SQL)
def stream_two_checkpoints(spark, sf):
    """Two streams with checkpoints of their own on one table, a compaction between and after, and the
    folders of folded epochs removed: no epoch replaces another one."""
    log = user_change_log(spark, sf)
    out, _ = streaming.new_paths(spark, "two_streams")
    table = lake.ChangeTable(spark, out, log.schema, "user_id", ["ts", "event_id"])
    for part in range(2):
        path = scratch_path(spark, "event_part")
        log.where(F.col("event_id") % 2 == part).repartition(2, "event_id").write.parquet(path)
        stream = file_stream(spark, path, log.schema, files_per_trigger=1)
        streaming.apply_stream(stream, table, streaming.new_paths(spark, "two_streams")[1])
        table.compact()
    table.remove_folded()
    return table.read()


@query("stream_two_mappings", "SELECT count(DISTINCT user_id) AS ids, count(DISTINCT user_id) AS keys FROM events")
def stream_two_mappings(spark, sf):
    """Ids given by two streams with checkpoints of their own."""
    users = load(spark, sf, "events").select("user_id")
    out, _ = streaming.new_paths(spark, "two_mappings")
    for part in range(2):
        path = scratch_path(spark, "user_part")
        users.where(F.col("user_id") % 3 >= part).write.parquet(path)
        stream = file_stream(spark, path, users.schema)
        streaming.map_stream(stream, out, "user_id", "salt", streaming.new_paths(spark, "two_mappings")[1])
    rows = spark.read.parquet(out)
    return rows.agg(F.count("uuid").alias("ids"), F.count_distinct("user_id").alias("keys"))
