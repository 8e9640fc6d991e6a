"""Keyed tables, joins, set operations, sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import keyed, mapping, masking, sampling
from tidewell.plans.registry import load, query

SALT = "query-salt"  # a throw-away value for the checks; real salts come from the environment

# Customers of the first 20 nations stored with ordering field 1; the changes carry balances
# raised by one for every other customer, half of them with an older ordering field.
UPSERT_SQL = """
WITH target AS (
  SELECT c_custkey, c_name, c_acctbal, 1 AS version FROM customer WHERE c_nationkey < 20),
changes AS (
  SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal,
         CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 2 END AS version
  FROM customer WHERE c_custkey % 2 = 0
  UNION ALL
  SELECT c_custkey, c_name, c_acctbal + 2, 3 FROM customer WHERE c_custkey % 6 = 0),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY version DESC) AS r
                        FROM changes) WHERE r = 1)
SELECT coalesce(t.c_custkey, l.c_custkey) AS c_custkey,
       CASE WHEN t.version IS NULL OR l.version >= t.version THEN l.c_name ELSE t.c_name END AS c_name,
       CASE WHEN t.version IS NULL OR l.version >= t.version THEN l.c_acctbal ELSE t.c_acctbal END
         AS c_acctbal,
       CASE WHEN t.version IS NULL OR l.version >= t.version THEN l.version ELSE t.version END AS version
FROM target t FULL JOIN last l USING (c_custkey)
"""


@query("upsert_by_key", UPSERT_SQL)
def upsert_by_key(spark, sf):
    customers = load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    target = customers.where("c_nationkey < 20").drop("c_nationkey").withColumn("version", F.lit(1))
    rows = customers.drop("c_nationkey")
    raised = F.col("c_acctbal") + 1
    changes = (
        rows.where("c_custkey % 2 = 0")
        .withColumn("c_acctbal", raised)
        .withColumn("version", F.when(F.col("c_custkey") % 4 == 0, 0).otherwise(2))
        .unionByName(
            rows.where("c_custkey % 6 = 0")
            .withColumn("c_acctbal", raised + 1)
            .withColumn("version", F.lit(3))
        )
    )
    return keyed.upsert_by_key(target, changes, "c_custkey", "version")


@query(
    "delete_by_key",
    """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""",
)
def delete_by_key(spark, sf):
    returned = load(spark, sf, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey")
    )
    return keyed.delete_by_key(
        load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), returned, "o_orderkey"
    )


@query(
    "update_by_key",
    """
SELECT c_custkey,
       CASE WHEN n.n IS NULL THEN c_acctbal ELSE CAST(n.n AS DOUBLE) END AS c_acctbal,
       CASE WHEN n.n IS NULL THEN c_mktsegment ELSE n.s END AS c_mktsegment
FROM customer LEFT JOIN (
  SELECT o_custkey, count(*) AS n, max(o_orderpriority) AS s FROM orders
  WHERE o_orderstatus = 'F' GROUP BY o_custkey) n ON o_custkey = c_custkey
""",
)
def update_by_key(spark, sf):
    changes = (
        load(spark, sf, "orders")
        .where("o_orderstatus = 'F'")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count("*").cast("double").alias("c_acctbal"),
            F.max("o_orderpriority").alias("c_mktsegment"),
        )
    )
    table = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return keyed.update_by_key(table, changes, "c_custkey", ["c_acctbal", "c_mktsegment"])


@query(
    "replace_rows",
    """
SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal >= 0
UNION ALL SELECT s_suppkey, 'replaced', 0 FROM supplier WHERE s_acctbal < 0
""",
)
def replace_rows(spark, sf):
    rows = load(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    fixed = rows.where("s_acctbal < 0").select(
        "s_suppkey", F.lit("replaced").alias("s_name"), F.lit(0.0).alias("s_acctbal")
    )
    return keyed.replace_rows(rows, fixed, "s_suppkey")


@query(
    "new_since_sync",
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""",
)
def new_since_sync(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return keyed.absent_by_key(orders, load(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")


@query(
    "present_keys",
    """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""",
)
def present_keys(spark, sf):
    urgent = load(spark, sf, "orders").where("o_orderpriority = '1-URGENT'")
    customers = load(spark, sf, "customer").select("c_custkey", "c_name")
    return keyed.present_by_key(customers, urgent, "c_custkey", "o_custkey")


@query(
    "either_key_absent",
    """
SELECT c_custkey AS id, c_nationkey AS account FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)
  AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = c_nationkey AND s_acctbal > 9000)
""",
)
def either_key_absent(spark, sf):
    candidates = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("account")
    )
    stored = load(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_acctbal") > 9000, F.col("s_nationkey")).alias("account"),
    )
    return keyed.either_key_absent(candidates, stored, ["id", "account"])


@query(
    "append_dedupe",
    """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events)
WHERE r = 1 AND user_id NOT IN (SELECT s_suppkey FROM supplier)
""",
)
def append_dedupe(spark, sf):
    stored = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("user_id"))
    incoming = load(spark, sf, "events").select("user_id", "event_id", "event_type")
    return keyed.append_dedupe(stored, incoming, "user_id", "event_id")


@query(
    "first_per_key",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_shipdate, l_linenumber, l_partkey, l_extendedprice) AS r FROM lineitem) WHERE r = 1
""",
)
def first_per_key(spark, sf):
    lines = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"
    )
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_extendedprice"]
    return keyed.first_per_key(lines, "l_orderkey", order).drop("l_shipdate")


@query(
    "pick_survivor",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_extendedprice DESC, l_partkey, l_suppkey) AS r FROM lineitem) WHERE r = 1
""",
)
def pick_survivor(spark, sf):
    lines = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    preference = [F.col("l_extendedprice").desc(), F.col("l_partkey"), F.col("l_suppkey")]
    return keyed.pick_survivor(lines, ["l_orderkey", "l_linenumber"], preference)


@query(
    "unmatched_both_ways",
    """
SELECT key, 'a' AS side FROM (SELECT c_custkey AS key FROM customer EXCEPT SELECT s_suppkey FROM supplier)
UNION ALL
SELECT key, 'b' FROM (SELECT s_suppkey AS key FROM supplier EXCEPT SELECT c_custkey FROM customer)
""",
)
def unmatched_both_ways(spark, sf):
    customers, suppliers = load(spark, sf, "customer"), load(spark, sf, "supplier")
    return keyed.unmatched_keys(customers, suppliers, "c_custkey", "s_suppkey")


@query(
    "unmatched_users",
    """
SELECT key, 'a' AS side FROM (SELECT user_id AS key FROM events WHERE event_type = 'purchase'
                              EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL
SELECT key, 'b' FROM (SELECT o_custkey AS key FROM orders WHERE o_orderstatus = 'P'
                      EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase')
""",
)
def unmatched_users(spark, sf):
    buyers = load(spark, sf, "events").where("event_type = 'purchase'")
    orders = load(spark, sf, "orders").where("o_orderstatus = 'P'")
    return keyed.unmatched_keys(buyers, orders, "user_id", "o_custkey")


@query(
    "unmatched_rows",
    """
SELECT 'orders' AS side, count(*) AS n, sum(CAST(o_custkey AS BIGINT))::BIGINT AS keys FROM orders
WHERE o_custkey NOT IN (SELECT user_id FROM events)
UNION ALL
SELECT 'events', count(*), sum(user_id)::BIGINT FROM events
WHERE user_id NOT IN (SELECT o_custkey FROM orders)
""",
)
def unmatched_rows(spark, sf):
    only_orders, only_events = keyed.unmatched_rows(
        load(spark, sf, "orders"), load(spark, sf, "events"), "o_custkey", "user_id"
    )

    def summary(df, side, key):
        return df.agg(F.count("*").alias("n"), F.sum(key).alias("keys")).select(
            F.lit(side).alias("side"), "n", "keys"
        )

    return summary(only_orders, "orders", "o_custkey").unionByName(
        summary(only_events, "events", "user_id")
    )


@query(
    "dup_values",
    """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY ALL HAVING count(*) > 1
""",
)
def dup_values(spark, sf):
    return keyed.duplicate_groups(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dedupe_any",
    """
SELECT count(*) AS n, count(DISTINCT l_orderkey) AS orders
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
""",
)
def dedupe_any(spark, sf):
    kept = load(spark, sf, "lineitem").dropDuplicates(["l_orderkey", "l_linenumber"])
    return kept.agg(F.count("*").alias("n"), F.count_distinct("l_orderkey").alias("orders"))


@query(
    "union_by_name",
    """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
""",
)
def union_by_name(spark, sf):
    customers = load(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("segment"),
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = load(spark, sf, "supplier").select(
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("key"),
        F.col("s_acctbal").alias("balance"),
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query(
    "differing_rows",
    """
WITH a AS (SELECT l_orderkey, l_linenumber FROM lineitem),
     b AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity <> 7),
     ca AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM a GROUP BY ALL),
     cb AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM b GROUP BY ALL)
SELECT l_orderkey, l_linenumber, coalesce(ca.n, 0) AS copies_a, coalesce(cb.n, 0) AS copies_b
FROM ca FULL JOIN cb USING (l_orderkey, l_linenumber)
WHERE coalesce(ca.n, 0) <> coalesce(cb.n, 0)
""",
)
def differing_rows(spark, sf):
    lines = load(spark, sf, "lineitem")
    columns = ["l_orderkey", "l_linenumber"]
    return keyed.differing_rows(lines.select(*columns), lines.where("l_quantity <> 7").select(*columns))


@query(
    "mask_join",
    f"""
SELECT sha256('{SALT}' || CAST(c_custkey AS VARCHAR)) AS cust_key, c_mktsegment,
       count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL
""",
)
def mask_join(spark, sf):
    tables = masked_tables(spark, sf)
    # Orders are summed per key before the join: a customer with most orders joins as one row.
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)"))
    per_key = tables["orders"].groupBy("cust_key").agg(
        F.count("*").alias("orders"), total.cast("double").alias("total")
    )
    return masking.join_masked(per_key, tables["customers"], "cust_key")


def masked_tables(spark, sf):
    customers = load(spark, sf, "customer").select(F.col("c_custkey").alias("cust_key"), "c_mktsegment")
    orders = load(spark, sf, "orders").select(
        F.col("o_custkey").alias("cust_key"), "o_orderkey", "o_totalprice"
    )
    return masking.mask_tables(
        {"customers": (customers, "cust_key"), "orders": (orders, "cust_key")}, SALT
    )


@query(
    "mask_join_rows",
    f"""
SELECT sha256('{SALT}' || CAST(c_custkey AS VARCHAR)) AS cust_key, c_mktsegment, o_orderkey, o_totalprice
FROM customer JOIN orders ON o_custkey = c_custkey
""",
)
def mask_join_rows(spark, sf):
    """The joined rows, with customers of more than 0.1 % of the orders split over tasks."""
    tables = masked_tables(spark, sf)
    return masking.join_masked(tables["orders"], tables["customers"], "cust_key", 0.001)


@query(
    "hot_keys",
    """
SELECT user_id FROM events GROUP BY user_id HAVING count(*) > 0.007 * (SELECT count(*) FROM events)
""",
)
def hot_keys(spark, sf):
    return keyed.hot_keys(load(spark, sf, "events"), "user_id", 0.007)


@query(
    "mask_column",
    f"""
SELECT CASE WHEN s_acctbal > 0 THEN sha256('{SALT}' || s_name) END AS s_name, s_suppkey FROM supplier
""",
)
def mask_column(spark, sf):
    rows = load(spark, sf, "supplier").select(
        F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("s_name"), "s_suppkey"
    )
    return masking.mask_column(rows, "s_name", SALT)


UUID_SQL = f"""
SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-'
       || substr('89ab', CAST(('0x' || substr(h, 17, 1)) AS INT) % 4 + 1, 1) || substr(h, 18, 3)
       || '-' || substr(h, 21, 12) AS uuid
FROM (SELECT c_custkey, sha256('{SALT}|0|' || CAST(c_custkey AS VARCHAR)) AS h FROM customer)
"""


@query("derived_uuid", UUID_SQL)
def derived_uuid(spark, sf):
    return load(spark, sf, "customer").select(
        "c_custkey", mapping.derived_uuid(F.col("c_custkey"), SALT).alias("uuid")
    )


@query(
    "mapping_sizes",
    """
SELECT step, floor(fraction * n)::BIGINT AS mapped, floor(fraction * n)::BIGINT AS uuids, kept
FROM (SELECT count(DISTINCT o_custkey) AS n FROM orders),
     (VALUES (1, 0.25, 0), (2, 0.5, 1)) steps(step, fraction, grown),
     LATERAL (SELECT CASE WHEN grown = 1 THEN floor(0.25 * n)::BIGINT ELSE 0 END AS kept)
""",
)
def mapping_sizes(spark, sf):
    """A mapping grown in two steps; every id of the first step must survive the second."""
    orders = load(spark, sf, "orders")
    empty = spark.createDataFrame([], "o_custkey long, uuid string")
    first = mapping.update_uuid_mapping(orders, empty, "o_custkey", SALT, 0.25).mapping
    second = mapping.update_uuid_mapping(orders, first, "o_custkey", SALT, 0.5).mapping
    kept = second.join(first, ["o_custkey", "uuid"], "left_semi")
    tagged = [
        first.select(F.lit(1).alias("step"), "o_custkey", "uuid", F.lit(0).alias("kept")),
        second.select(F.lit(2).alias("step"), "o_custkey", "uuid", F.lit(0).alias("kept")),
        kept.select(F.lit(2).alias("step"), "o_custkey", "uuid", F.lit(1).alias("kept")),
    ]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("step")
        .agg(
            F.count_if(F.col("kept") == 0).alias("mapped"),
            F.count_distinct("uuid").alias("uuids"),
            F.sum("kept").alias("kept"),
        )
    )


@query(
    "sync_sampled_copy",
    """
SELECT floor(0.5 * n)::BIGINT AS first_rows, (n - floor(0.5 * n))::BIGINT AS added, n AS uuids
FROM (SELECT count(*) AS n FROM customer)
""",
)
def sync_sampled_copy(spark, sf):
    """A copy of half the customers, then the sync that adds the rest."""
    customers = load(spark, sf, "customer").select("c_custkey", "c_name")
    first = mapping.sync_sampled_copy(customers, None, "c_custkey", SALT)
    added = mapping.sync_sampled_copy(customers, first, "c_custkey", SALT)
    tagged = first.withColumn("added", F.lit(0)).unionByName(added.withColumn("added", F.lit(1)))
    return tagged.agg(
        F.count_if(F.col("added") == 0).alias("first_rows"),
        F.count_if(F.col("added") == 1).alias("added"),
        F.count_distinct("uuid").alias("uuids"),
    )


@query(
    "sample_exact_size",
    """
SELECT floor(0.4 * count(*))::BIGINT AS rows, floor(0.4 * count(*))::BIGINT AS keys FROM orders
""",
)
def sample_exact_size(spark, sf):
    picked = sampling.sample_fraction(load(spark, sf, "orders"), "o_orderkey", 0.4, seed=7)
    return picked.agg(F.count("*").alias("rows"), F.count_distinct("o_orderkey").alias("keys"))


@query("sample_exact_rows")
def sample_exact_rows(spark, sf):
    return sampling.sample_exact(load(spark, sf, "customer"), "c_custkey", 10, seed=3)


@query(
    "first_n",
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100",
)
def first_n(spark, sf):
    return sampling.first_n(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 100)


@query(
    "first_rows_by_ranges",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 4000",
)
def first_rows_by_ranges(spark, sf):
    """More first rows than one task is asked to merge: whole ranges, and the one with the cut in finer ranges."""
    rows = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return sampling.first_n(rows, ["o_orderdate", "o_orderkey"], 4000, few=200)


@query(
    "load_long_chain",
    """
SELECT c_custkey, c_custkey % 2 = 0 AS loaded FROM customer
""",
)
def load_long_chain(spark, sf):
    """All customers in one chain of shared keys, each the next one's rival: every second one is loaded."""
    rows = load(spark, sf, "customer").select(
        "c_custkey", F.floor(F.col("c_custkey") / 2).alias("id"), F.floor((F.col("c_custkey") + 1) / 2).alias("account")
    )
    loaded, refused = mapping.load_skipping_duplicates(rows.limit(0), rows, ["id", "account"], ["c_custkey"])
    return loaded.select("c_custkey", F.lit(True).alias("loaded")).unionByName(
        refused.select("c_custkey", F.lit(False).alias("loaded"))
    )


@query(
    "load_skipping_duplicates",
    """
WITH s AS (SELECT s_suppkey AS id, s_nationkey AS account FROM supplier WHERE s_acctbal > 5000)
SELECT count(*) AS offered, count(*) FILTER (c_custkey IN (SELECT id FROM s)
       OR c_nationkey IN (SELECT account FROM s)) AS blocked_by_stored,
       count(DISTINCT c_nationkey) FILTER (NOT (c_custkey IN (SELECT id FROM s)
       OR c_nationkey IN (SELECT account FROM s))) AS loaded
FROM customer
""",
)
def load_skipping_duplicates(spark, sf):
    """Customers loaded under unique id and unique nation: ids are distinct already."""
    stored = (
        load(spark, sf, "supplier")
        .where("s_acctbal > 5000")
        .select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("account"))
    )
    incoming = load(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("account")
    )
    loaded, rejected = mapping.load_skipping_duplicates(incoming=incoming, existing=stored,
                                                        unique_keys=["id", "account"], order=["id"])
    clash = keyed.either_key_absent(incoming, stored, ["id", "account"])
    counts = {
        "loaded": loaded.agg(F.count("*").alias("n")),
        "rejected": rejected.agg(F.count("*").alias("n")),
        "free": clash.agg(F.count("*").alias("n")),
    }
    stacked = None
    for name, df in counts.items():
        part = df.select(F.lit(name).alias("what"), "n")
        stacked = part if stacked is None else stacked.unionByName(part)

    def of(name):
        return F.sum(F.when(F.col("what") == name, F.col("n")).otherwise(0))

    return stacked.agg(
        (of("loaded") + of("rejected")).alias("offered"),
        (of("loaded") + of("rejected") - of("free")).alias("blocked_by_stored"),
        of("loaded").alias("loaded"),
    )


@query(
    "repair_unique",
    """
SELECT count(*) AS rows, count(*) AS accounts FROM customer
""",
)
def repair_unique(spark, sf):
    """Customers given account numbers that collide, repaired to be unique."""
    n = F.xxhash64("c_custkey")
    rows = load(spark, sf, "customer").select(
        "c_custkey", F.format_string("ACC%06d", F.pmod(n, F.lit(5000))).alias("account")
    )
    stored = load(spark, sf, "supplier").select(F.format_string("ACC%06d", "s_suppkey").alias("account"))
    fixed, _ = mapping.repair_unique(
        rows,
        stored,
        "account",
        order=["c_custkey"],
        redraw=lambda attempt: F.format_string(
            "ACC%012d", F.pmod(F.xxhash64("c_custkey", F.lit(attempt)), F.lit(10**12))
        ),
    )
    return fixed.agg(F.count("*").alias("rows"), F.count_distinct("account").alias("accounts"))


@query(
    "repair_two_columns",
    """
WITH o AS (SELECT o_orderkey AS n, o_custkey AS id, 'A' || (o_orderkey % 7000) AS account FROM orders),
stored AS (SELECT c_custkey AS id, 'A' || (c_custkey * 3) AS account FROM customer WHERE c_custkey % 4 = 0),
judged AS (
  SELECT n, (row_number() OVER (PARTITION BY id ORDER BY n) > 1 OR id IN (SELECT id FROM stored)) AS bad_id,
         (row_number() OVER (PARTITION BY account ORDER BY n) > 1 OR account IN (SELECT account FROM stored))
           AS bad_account FROM o)
SELECT 'all' AS what, count(*) AS rows FROM judged
UNION ALL SELECT 'accepted', count(*) FILTER (NOT (bad_id AND n % 10 = 0)) FROM judged
UNION ALL SELECT 'rejected', count(*) FILTER (bad_id AND n % 10 = 0) FROM judged
UNION ALL SELECT 'ids', count(*) FILTER (NOT (bad_id AND n % 10 = 0)) FROM judged
UNION ALL SELECT 'accounts', count(*) FILTER (NOT (bad_id AND n % 10 = 0)) FROM judged
UNION ALL SELECT 'stored again', 0
UNION ALL SELECT 'redrawn ids', count(*) FILTER (bad_id) + count(*) FILTER (bad_id AND n % 10 = 0) FROM judged
UNION ALL SELECT 'redrawn accounts', count(*) FILTER (bad_account) FROM judged
""",
)
def repair_two_columns(spark, sf):
    """Orders whose customer and account numbers repeat and clash with stored ones. Every tenth order
    can only draw a stored id, so it stays without one and is returned."""
    rows = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("n"), F.col("o_custkey").alias("id"),
        F.concat(F.lit("A"), (F.col("o_orderkey") % 7000).cast("string")).alias("account"),
    )
    customers = load(spark, sf, "customer").where("c_custkey % 4 = 0")
    stored = customers.select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("A"), (F.col("c_custkey") * 3).cast("string")).alias("account")
    )
    taken = customers.agg(F.min("c_custkey")).first()[0]
    done = mapping.repair_unique_columns(
        rows,
        stored,
        {
            "id": lambda attempt: F.when(F.col("n") % 10 == 0, F.lit(taken)).otherwise(
                F.lit(10**9 * attempt) + F.col("n")
            ),
            "account": lambda attempt: F.concat(F.lit(f"B{attempt}-"), F.col("n").cast("string")),
        },
        order=["n"],
        max_attempts=2,
    )
    again = keyed.present_by_key(done.accepted, stored, "id").unionByName(
        keyed.present_by_key(done.accepted, stored, "account")
    )
    counts = [
        ("all", rows.agg(F.count("*").alias("rows"))),
        ("accepted", done.accepted.agg(F.count("*").alias("rows"))),
        ("rejected", done.rejected.agg(F.count("*").alias("rows"))),
        ("ids", done.accepted.agg(F.count_distinct("id").alias("rows"))),
        ("accounts", done.accepted.agg(F.count_distinct("account").alias("rows"))),
        ("stored again", again.agg(F.count("*").alias("rows"))),
    ]
    drawn = spark.createDataFrame(
        [(f"redrawn {c}s", n) for c, n in done.regenerated.items()], "what string, rows long"
    )
    parts = [df.select(F.lit(what).alias("what"), "rows") for what, df in counts]
    return reduce(DataFrame.unionByName, [*parts, drawn])


@query(
    "update_by_key_latest",
    """
SELECT c_custkey, coalesce(p, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN (
  SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS p FROM orders GROUP BY 1)
  ON o_custkey = c_custkey
""",
)
def update_by_key_latest(spark, sf):
    """Every order of a customer is a change; the newest one counts."""
    changes = load(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("c_mktsegment"), "o_orderdate", "o_orderkey"
    )
    table = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return keyed.update_by_key(table, changes, "c_custkey", "c_mktsegment", order=["o_orderdate", "o_orderkey"])


@query(
    "sample_by_digest",
    "SELECT c_custkey, c_name FROM customer ORDER BY md5('3|' || c_custkey) LIMIT 100",
)
def sample_by_digest(spark, sf):
    """An exact sample in an order that other engines can form."""
    rows = load(spark, sf, "customer").select("c_custkey", "c_name")
    return sampling.sample_exact(rows, "c_custkey", 100, order=sampling.digest_order("c_custkey", 3))
