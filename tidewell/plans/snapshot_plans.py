"""Snapshots in frames over the events, read as changes of a per-user row."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import cdc, schema_versions
from tidewell.operators.snapshot import ChunkedSnapshot
from tidewell.operators.synth import spread
from tidewell.plans.cdc_plans import user_change_log
from tidewell.plans.registry import load, query
from tidewell.session import scratch_path

TAKES = 5  # one chunk each


def framed_snapshot(spark, sf):
    """Five chunks of the users; the source moves on by a twentieth of the log from each low position to the read,
    and as much again to the high one. The log that is kept begins at the first frame."""
    log = user_change_log(spark, sf).select("user_id", "event_id", "event_type", "value", "op")
    ends = log.agg(F.max("event_id").alias("e"), F.max("user_id").alias("u")).first()
    step = ends["e"] // 20
    now = {"at": step}

    def source():
        now["at"] += step
        state = cdc.latest_changes(log.where(F.col("event_id") <= now["at"]), "user_id", "event_id")
        return cdc.live_rows(state).select("user_id", "event_type", "value")

    def position():
        if now["at"] % (2 * step) == 0:  # after a read
            now["at"] += step
        return now["at"]

    snapshot = ChunkedSnapshot(spark, scratch_path(spark, "snapshot"), "user_id")
    snapshot.plan(log, TAKES, [ends["u"] * (k + 1) // TAKES for k in range(TAKES - 1)])
    for _ in snapshot.take_all(source, position):
        pass
    return snapshot, log.where(F.col("event_id") > step)


@query(
    "snapshot_in_frames",
    """
SELECT user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events)
WHERE r = 1 AND event_type <> 'error'
""",
)
def snapshot_in_frames(spark, sf):
    """Chunks read at five states of the source and a log without its beginning: together the table as it is."""
    snapshot, log = framed_snapshot(spark, sf)
    return snapshot.table(log, "event_id").select("user_id", "event_type", "value")


@query(
    "snapshot_frames",
    f"""
WITH ends AS (SELECT max(event_id) // 20 AS step, max(user_id) AS u FROM events),
frames AS (
  SELECT CAST(k AS INTEGER) AS chunk, step * (2 * k + 1) AS low, step * (2 * k + 2) AS seen, step * (2 * k + 3) AS high,
         CASE k WHEN 0 THEN -1 ELSE u * k // {TAKES} END AS above,
         CASE k WHEN {TAKES - 1} THEN u ELSE u * (k + 1) // {TAKES} END AS upto
  FROM ends, range({TAKES}) AS t(k)),
seen AS (
  SELECT chunk, low, high, user_id, event_type,
         row_number() OVER (PARTITION BY chunk, user_id ORDER BY event_id DESC) AS r
  FROM frames JOIN events ON event_id <= seen AND user_id > above AND user_id <= upto),
held AS (SELECT * FROM seen WHERE r = 1 AND event_type <> 'error')
SELECT f.chunk, f.low, f.high, count(h.user_id) AS rows_read,
       count(h.user_id) FILTER (EXISTS (
         SELECT 1 FROM events e WHERE e.user_id = h.user_id AND e.event_id > f.low AND e.event_id <= f.high)) AS rows_discarded
FROM frames f LEFT JOIN held h ON f.chunk = h.chunk GROUP BY f.chunk, f.low, f.high
""",
)
def snapshot_frames(spark, sf):
    """What each frame read and what changed inside it."""
    snapshot, log = framed_snapshot(spark, sf)
    return snapshot.report(log, "event_id")


VERSIONS = (
    (0, "c_custkey int, c_acctbal int"),
    (1, "c_custkey bigint, c_acctbal decimal(12,2), c_mktsegment string"),
    (2, "c_custkey bigint, c_acctbal decimal(15,4), c_nationkey string, c_mktsegment string"),
)


@query(
    "schema_versions_applied",
    """
WITH ends AS (SELECT max(o_orderkey) // 3 AS step FROM orders),
last AS (
  SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus, o_orderpriority, least(o_orderkey // (step + 1), 2) AS v,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r
  FROM orders, ends)
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS c_acctbal,
       CAST(NULL AS VARCHAR) AS c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey
FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL
SELECT o_custkey,
       CASE v WHEN 0 THEN floor(o_totalprice) ELSE CAST(CAST(round(o_totalprice, 2) AS DECIMAL(15,4)) AS DOUBLE) END,
       CASE WHEN v >= 1 THEN o_orderstatus END, CASE WHEN v = 2 THEN o_orderpriority END
FROM last WHERE r = 1 AND o_orderkey % 7 <> 0
""",
)
def schema_versions_applied(spark, sf):
    """Customers after a log of orders whose payload changed its schema twice: one plan, one target schema."""
    orders = load(spark, sf, "orders")
    step = orders.agg(F.floor(F.max("o_orderkey") / 3)).first()[0]
    changes = [(0 if not i else i * (step + 1), ddl) for i, ddl in VERSIONS]
    versions = schema_versions.versions_of(spark.createDataFrame(changes, "position long, schema string"))
    price = F.format_string("%.2f", "o_totalprice")
    written = [
        F.concat(F.lit('{"c_custkey":'), F.col("o_custkey"), F.lit(',"c_acctbal":'), F.floor("o_totalprice"), F.lit("}")),
        F.concat(F.lit('{"c_custkey":'), F.col("o_custkey"), F.lit(',"c_acctbal":'), price, F.lit(',"c_mktsegment":"'),
                 F.col("o_orderstatus"), F.lit('"}')),
        F.concat(F.lit('{"c_custkey":'), F.col("o_custkey"), F.lit(',"c_acctbal":'), price, F.lit(',"c_nationkey":"'),
                 F.col("o_orderpriority"), F.lit('","c_mktsegment":"'), F.col("o_orderstatus"), F.lit('"}')),
    ]
    at = F.floor(F.col("o_orderkey") / (step + 1))
    read = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    events = spread(read).select(
        F.col("o_orderkey").alias("pos"), F.col("o_custkey").alias("c_custkey"),
        F.when(F.col("o_orderkey") % 7 == 0, "D").otherwise("U").alias("op"),
        F.when(at == 0, written[0]).when(at == 1, written[1]).otherwise(written[2]).alias("payload"),
    )
    table = load(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("c_custkey"), F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment"), F.col("c_nationkey").cast("int").alias("c_nationkey"),
    )
    applied = schema_versions.apply_versioned(table, events, versions, "c_custkey", "payload", "pos")
    return applied.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))
