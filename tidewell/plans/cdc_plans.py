"""Change-data-capture queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewell.functions import clock, codes
from tidewell.operators import cdc
from tidewell.plans.registry import load, query

# The order events used below, as SQL: one event per order, its operation given by the key.
ORDER_EVENTS_SQL = """
ev AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
         CASE o_orderkey % 3 WHEN 1 THEN 'I' WHEN 2 THEN 'U' ELSE 'D' END AS op_type,
         o_orderstatus AS status, o_orderstatus || '-old' AS old_status
  FROM orders)
"""


def order_events(spark, sf):
    """Envelopes over the orders: updates change the status, and each key has one event."""
    orders = load(spark, sf, "orders")
    op = codes.operation_by_modulo(F.col("o_orderkey"))
    after = cdc.image_struct(orders, ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    before = cdc.changed_image(
        after, {"o_orderstatus": F.concat(F.col("o_orderstatus"), F.lit("-old"))}
    )
    return cdc.build_envelope(
        orders,
        "SALES.ORDERS",
        op,
        before=before,
        after=after,
        op_ts=F.col("o_orderdate"),
        current_ts=F.col("o_orderdate"),
        csn=cdc.commit_number(F.col("o_orderkey")),
        pos=cdc.log_position(F.col("o_orderkey")),
    )


@query(
    "cdc_envelope_ops",
    f"""
WITH {ORDER_EVENTS_SQL}
SELECT op_type, count(*) AS events,
       count(*) FILTER (op_type <> 'I') AS before_images,
       count(*) FILTER (op_type <> 'D') AS after_images
FROM ev GROUP BY op_type
""",
)
def envelope_ops(spark, sf):
    return (
        order_events(spark, sf)
        .groupBy("op_type")
        .agg(
            F.count("*").alias("events"),
            F.count("before").alias("before_images"),
            F.count("after").alias("after_images"),
        )
    )


@query(
    "cdc_envelope_rows",
    f"""
WITH {ORDER_EVENTS_SQL}
SELECT op_type, 'SALES.ORDERS' AS "table",
       CAST(100000000 + o_orderkey AS VARCHAR) AS csn,
       CAST(20000000000000000000::HUGEINT + o_orderkey AS VARCHAR) AS pos,
       CASE WHEN op_type <> 'I' THEN old_status END AS before_status,
       CASE WHEN op_type <> 'D' THEN status END AS after_status
FROM ev
""",
)
def envelope_rows(spark, sf):
    return order_events(spark, sf).select(
        "op_type",
        "table",
        "csn",
        "pos",
        F.col("before.o_orderstatus").alias("before_status"),
        F.col("after.o_orderstatus").alias("after_status"),
    )


@query(
    "cdc_envelope_shifted_positions",
    """
SELECT o_orderkey,
       CAST(100000000 + o_orderkey + CASE o_orderkey % 3 WHEN 1 THEN 0 WHEN 2 THEN 1000 ELSE 2000 END
            AS VARCHAR) AS csn,
       CAST(20000000000000000000::HUGEINT + o_orderkey
            + CASE o_orderkey % 3 WHEN 1 THEN 0 WHEN 2 THEN 1000 ELSE 2000 END AS VARCHAR) AS pos
FROM orders
""",
)
def envelope_shifted_positions(spark, sf):
    key = F.col("o_orderkey")
    op = codes.operation_by_modulo(key)
    return load(spark, sf, "orders").select(
        "o_orderkey",
        cdc.commit_number(key, op).alias("csn"),
        cdc.log_position(key, op).alias("pos"),
    )


@query(
    "cdc_final_values",
    f"""
WITH {ORDER_EVENTS_SQL}
SELECT o_orderkey, o_custkey, o_totalprice, op_type,
       CASE WHEN op_type = 'D' THEN old_status ELSE status END AS o_orderstatus
FROM ev
""",
)
def final_values(spark, sf):
    return cdc.final_values(order_events(spark, sf)).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "op_type"
    )


@query(
    "cdc_merge_after_wins",
    f"""
WITH {ORDER_EVENTS_SQL}
SELECT CASE WHEN op_type <> 'D' THEN o_orderkey END AS o_orderkey,
       CASE WHEN op_type <> 'D' THEN o_custkey END AS o_custkey,
       CASE WHEN op_type <> 'D' THEN status END AS o_orderstatus,
       CASE WHEN op_type <> 'D' THEN o_totalprice END AS o_totalprice
FROM ev
""",
)
def merge_after_wins(spark, sf):
    return cdc.merge_images(order_events(spark, sf), "after_wins")


@query(
    "cdc_merge_by_op",
    f"""
WITH {ORDER_EVENTS_SQL}
SELECT o_orderkey, o_custkey, o_totalprice,
       CASE WHEN op_type = 'D' THEN old_status ELSE status END AS o_orderstatus
FROM ev
""",
)
def merge_by_op(spark, sf):
    return cdc.merge_images(order_events(spark, sf), "by_op")


@query(
    "cdc_merge_coalesce",
    f"""
WITH {ORDER_EVENTS_SQL}
SELECT o_orderkey, o_custkey, o_totalprice,
       CASE WHEN op_type = 'D' THEN old_status ELSE status END AS o_orderstatus
FROM ev
""",
)
def merge_coalesce(spark, sf):
    return cdc.merge_images(order_events(spark, sf), "coalesce")


@query(
    "cdc_operation_codes",
    """
SELECT event_type,
       CASE event_type WHEN 'signup' THEN 'I' WHEN 'purchase' THEN 'U' WHEN 'error' THEN 'D'
            WHEN 'view' THEN 'R' ELSE 'quarantined' END AS op, count(*) AS n
FROM events GROUP BY ALL
""",
)
def operation_codes(spark, sf):
    dialect = {"signup": "c", "purchase": "u", "error": "d", "view": "R"}
    raw = load(spark, sf, "events").select(
        "event_type", codes.lookup(F.col("event_type"), dialect, "?").alias("op")
    )
    known, unknown = cdc.normalise_operations(raw, "op")
    return (
        known.unionByName(unknown.withColumn("op", F.lit("quarantined")))
        .groupBy("event_type", "op")
        .agg(F.count("*").alias("n"))
    )


def user_change_log(spark, sf):
    """Events read as changes of a per-user row; an error event deletes the user."""
    return load(spark, sf, "events").select(
        "user_id",
        "event_id",
        "ts",
        "event_type",
        "value",
        F.when(F.col("event_type") == "error", "D")
        .when(F.col("event_type") == "signup", "I")
        .otherwise("U")
        .alias("op"),
    )


@query(
    "cdc_latest_event",
    """
SELECT user_id, event_id, ts, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
      FROM events) WHERE r = 1
""",
)
def latest_event(spark, sf):
    return cdc.latest_changes(load(spark, sf, "events").drop("props"), "user_id", ["ts", "event_id"])


@query(
    "cdc_apply_latest",
    """
WITH last AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
    FROM events) WHERE r = 1)
SELECT user_id, event_id, event_type, value FROM last WHERE event_type <> 'error'
UNION ALL
SELECT c_custkey, CAST(0 AS BIGINT), c_mktsegment, c_acctbal FROM customer
WHERE NOT EXISTS (SELECT 1 FROM last WHERE last.user_id = c_custkey)
""",
)
def apply_latest(spark, sf):
    table = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.lit(0).cast("long").alias("event_id"),
        F.col("c_mktsegment").alias("event_type"),
        F.col("c_acctbal").alias("value"),
    )
    return cdc.apply_changes(table, user_change_log(spark, sf), "user_id", ["ts", "event_id"])


@query(
    "cdc_merge_with_markers",
    """
WITH parts AS (
  SELECT user_id, event_id, ts, event_type FROM events WHERE ts < TIMESTAMP '2024-01-16'
  UNION ALL
  SELECT user_id, event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10')
SELECT user_id, event_id, ts, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM parts)
WHERE r = 1 AND event_type <> 'error'
""",
)
def merge_with_markers(spark, sf):
    """A state built from the late part first, then the early part, which must change little."""
    log = user_change_log(spark, sf)
    early = log.where(F.col("ts") < clock.wall_literal(dt.datetime(2024, 1, 16)))
    late = log.where(F.col("ts") >= clock.wall_literal(dt.datetime(2024, 1, 10)))
    order = ["ts", "event_id"]
    state = cdc.latest_changes(late, "user_id", order)
    merged = cdc.merge_with_markers(state, early, "user_id", order)
    return cdc.live_rows(merged).select("user_id", "event_id", "ts", "event_type")


@query(
    "cdc_snapshot_reconcile",
    """
WITH all_rows AS (
  SELECT user_id, event_id, event_type FROM events
  UNION ALL
  SELECT c_custkey, CAST(5000 AS BIGINT), 'snapshot' FROM customer)
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC, event_type DESC) AS r
  FROM all_rows) WHERE r = 1 AND event_type <> 'error'
""",
)
def snapshot_reconcile(spark, sf):
    """A re-read of all customers at position 5000 amid the changes."""
    snapshot = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.lit(5000).cast("long").alias("event_id"),
        F.lit("snapshot").alias("event_type"),
        F.lit("R").alias("op"),
    )
    changes = user_change_log(spark, sf).select("user_id", "event_id", "event_type", "op")
    return cdc.reconcile_snapshot(
        snapshot, changes, "user_id", [cdc.position_number(F.col("event_id")), "event_type"]
    ).drop("op")


@query(
    "cdc_position_order",
    """
SELECT max(event_id) AS by_number, max(CAST(event_id AS VARCHAR)) AS by_text FROM events
""",
)
def position_order(spark, sf):
    text = F.col("event_id").cast("string")
    return load(spark, sf, "events").agg(
        F.max(cdc.position_number(text)).cast("long").alias("by_number"),
        F.max(text).alias("by_text"),
    )


AUDIT_SQL = """
WITH new AS (
  SELECT c_custkey,
         CASE WHEN c_acctbal < 0 THEN 'BLOCKED' ELSE c_mktsegment END AS c_mktsegment,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS c_name
  FROM customer),
pairs AS (
  SELECT c.c_custkey, 'c_mktsegment' AS "column", c.c_mktsegment AS old, n.c_mktsegment AS new
  FROM customer c JOIN new n USING (c_custkey)
  UNION ALL
  SELECT c.c_custkey, 'c_name', c.c_name, n.c_name FROM customer c JOIN new n USING (c_custkey))
SELECT c_custkey, "column", old, new FROM pairs WHERE old IS DISTINCT FROM new
"""


def _altered_customers(customers):
    return customers.select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, "BLOCKED").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_name")).alias("c_name"),
    )


@query("audit_changes", AUDIT_SQL)
def audit_changes(spark, sf):
    customers = load(spark, sf, "customer")
    return cdc.audit_changes(
        customers, _altered_customers(customers), "c_custkey", ["c_mktsegment", "c_name"]
    )


@query(
    "audit_envelope",
    f"""
WITH {ORDER_EVENTS_SQL}
SELECT o_orderkey, 'o_orderstatus' AS "column", old_status AS old, status AS new
FROM ev WHERE op_type = 'U'
""",
)
def audit_envelope(spark, sf):
    return cdc.audit_envelope(
        order_events(spark, sf), ["o_orderkey"], ["o_orderstatus", "o_totalprice"]
    )


@query(
    "wall_clock",
    """
SELECT event_id, date_trunc('millisecond', ts) AS wall FROM events
""",
)
def wall_clock(spark, sf):
    """Event times written with an offset, then read back as the local time."""
    offset = F.element_at(
        F.array(*[F.lit(o) for o in ("+07:00", "-03:30", "Z")]),
        (F.pmod("event_id", F.lit(3)) + 1).cast("int"),
    )
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), offset)
    return load(spark, sf, "events").select("event_id", clock.wall_clock(text).alias("wall"))


@query(
    "typed_json_decode",
    """
SELECT c_custkey, c_mktsegment AS segment, c_acctbal AS balance, c_nationkey AS nation,
       CAST(NULL AS VARCHAR) AS missing, 'R' AS op_type
FROM customer
""",
)
def typed_json_decode(spark, sf):
    """Customers written as union-wrapped JSON events and decoded again."""
    wrapped = F.to_json(
        F.struct(
            F.struct(F.lit("R").alias("string")).alias("op_type"),
            F.struct(
                F.struct(
                    F.struct(F.col("c_custkey").alias("long")).alias("KEY"),
                    F.struct(F.col("c_mktsegment").alias("string")).alias("SEGMENT"),
                    F.struct(F.col("c_acctbal").alias("double")).alias("BALANCE"),
                    F.struct(F.col("c_nationkey").alias("long")).alias("NATION"),
                ).alias("row")
            ).alias("after"),
        )
    )
    fields = {
        "KEY": "long",
        "SEGMENT": "string",
        "BALANCE": "double",
        "NATION": "int",
        "MISSING": "string",
    }
    written = load(spark, sf, "customer").select(wrapped.alias("text"))
    return cdc.decode_typed_json(written, "text", fields, "e").select(
        F.col("e.after.KEY").alias("c_custkey"),
        F.col("e.after.SEGMENT").alias("segment"),
        F.col("e.after.BALANCE").alias("balance"),
        F.col("e.after.NATION").alias("nation"),
        F.col("e.after.MISSING").alias("missing"),
        F.col("e.op_type").alias("op_type"),
    )


@query(
    "schema_signals",
    """
SELECT s_name || '_snap_20240301' AS id, 'execute-snapshot' AS type,
       '{"data-collections":["dbo.' || s_name || '"]}' AS data
FROM supplier WHERE s_nationkey <> 2
""",
)
def schema_signals(spark, sf):
    return cdc.snapshot_signals(_schema_log(spark, sf), dt.date(2024, 3, 1))


def _schema_log(spark, sf):
    """Suppliers stand for tables: a closed row each, and open or (in nation 2) closed ones."""
    log = load(spark, sf, "supplier").select(
        F.col("s_name").alias("table_name"),
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_nationkey") == 2, 1).otherwise(0).alias("processed"),
    )
    closed = log.withColumn("id", -F.col("id") - 1).withColumn("processed", F.lit(1))
    return log.unionByName(closed)


@query(
    "schema_log_marked",
    """
SELECT s_name AS table_name, s_suppkey AS id, 1 AS processed FROM supplier
UNION ALL SELECT s_name, -s_suppkey - 1, 1 FROM supplier
""",
)
def schema_log_marked(spark, sf):
    return cdc.mark_processed(_schema_log(spark, sf))


@query(
    "cdc_final_values_scalar",
    f"""
WITH {ORDER_EVENTS_SQL}
SELECT o_orderkey, CASE WHEN op_type = 'D' THEN old_status ELSE status END AS o_orderstatus, op_type FROM ev
""",
)
def final_values_scalar(spark, sf):
    """The form for frames that hold one operation each."""
    events = order_events(spark, sf)
    fields = ["o_orderkey", "o_orderstatus"]
    parts = [
        cdc.final_values_for(events.where(F.col("op_type") == op), op, fields) for op in ("I", "U", "D")
    ]
    return cdc.union_all(parts).select(*fields, "op_type")


@query(
    "cdc_tombstones",
    """
SELECT CASE WHEN o_orderstatus = 'P' THEN 'tombstone' ELSE 'event' END AS kind, count(*) AS n
FROM orders GROUP BY ALL
""",
)
def tombstones(spark, sf):
    """Records of pending orders lose both images and are routed apart."""
    image = F.struct("o_orderkey", "o_orderstatus")
    kept = F.when(F.col("o_orderstatus") != "P", image)
    records = load(spark, sf, "orders").select(kept.alias("before"), kept.alias("after"))
    events, empty = cdc.split_tombstones(records)
    tagged = events.select(F.lit("event").alias("kind")).unionByName(
        empty.select(F.lit("tombstone").alias("kind"))
    )
    return tagged.groupBy("kind").agg(F.count("*").alias("n"))


@query(
    "typed_json_malformed",
    """
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS balance,
       c_custkey % 7 = 0 OR c_custkey % 11 = 0 AS malformed
FROM customer
""",
)
def typed_json_malformed(spark, sf):
    """Values that are not of their column's type, and cut texts, are flagged and fail nothing."""
    key = F.col("c_custkey")
    balance = F.when(key % 7 == 0, F.lit("much")).otherwise(F.col("c_acctbal").cast("string"))
    written = F.to_json(
        F.struct(F.struct(F.struct(F.struct(balance.alias("double")).alias("BALANCE")).alias("row")).alias("after"))
    )
    texts = load(spark, sf, "customer").withColumn("written", written).select(
        "c_custkey", F.when(key % 11 == 0, F.expr("substring(written, 1, 20)")).otherwise(F.col("written")).alias("text")
    )
    decoded = cdc.decode_typed_json(texts, "text", {"BALANCE": "double"}, "e")
    return decoded.select("c_custkey", F.col("e.after.BALANCE").alias("balance"), "e.malformed")


@query(
    "cdc_null_keys",
    """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 5 <> 0
UNION ALL SELECT c_custkey, 'NEW' FROM customer WHERE c_custkey % 10 = 5
""",
)
def cdc_null_keys(spark, sf):
    """A log with events that carry no key, applied twice: the same as once, and no row without a key."""
    table = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    log = table.where("c_custkey % 5 = 0").select(
        "c_custkey", F.lit("NEW").alias("c_mktsegment"), F.lit(1).alias("pos"),
        F.when(F.col("c_custkey") % 10 == 0, "D").otherwise("U").alias("op"),
    )
    keyless = log.withColumn("c_custkey", F.lit(None).cast("long"))
    log = log.unionByName(keyless)
    once = cdc.apply_changes(table, log, "c_custkey", "pos")
    return cdc.apply_changes(once, log, "c_custkey", "pos")
