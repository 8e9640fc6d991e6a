"""Quality, reconciliation and profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import fingerprints, quality, reconcile
from tidewell.operators.quality_states import QualityStates
from tidewell.plans.io_plans import orders_by_year
from tidewell.plans.registry import TABLES, load, query
from tidewell.session import scratch_path
from tidewell.sources.tables import table_counts

NAME_PATTERN = r"^[A-Za-z\s]+$"  # fixed value: the name rule


@query(
    "table_row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES),
)
def table_row_counts(spark, sf):
    return table_counts({t: load(spark, sf, t) for t in TABLES})


ORDER_RULES = [
    {"rule": "row_count", "above": 100},
    {"rule": "not_null", "column": "o_custkey"},
    {"rule": "matches", "column": "o_orderpriority", "pattern": "^[0-3]-"},
    {"rule": "max_length", "column": "o_orderpriority", "length": 8},
    {"rule": "unique", "column": "o_orderkey"},
    {"rule": "unique", "column": "o_custkey"},
    {"rule": "duplicate_count", "column": "o_custkey"},
    {"rule": "schema", "column": "o_orderkey", "type": "integer"},
    {"rule": "schema", "column": "o_totalprice", "type": "string"},
]
MONTHS = ("1995-03", "1996-10")


@query(
    "dq_range_from_states",
    f"""
WITH o AS (SELECT * FROM orders WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '{MONTHS[0]}' AND '{MONTHS[1]}'),
d AS (SELECT count(*) AS n FROM o GROUP BY o_custkey HAVING count(*) > 1),
r(rule, "column", observed, threshold) AS (
  SELECT 'row_count', CAST(NULL AS VARCHAR), count(*), 100::BIGINT FROM o
  UNION ALL SELECT 'not_null', 'o_custkey', count(*) FILTER (o_custkey IS NULL), 0 FROM o
  UNION ALL SELECT 'matches', 'o_orderpriority', count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[0-3]-')), 0 FROM o
  UNION ALL SELECT 'max_length', 'o_orderpriority', count(*) FILTER (length(o_orderpriority) > 8), 0 FROM o
  UNION ALL SELECT 'unique', 'o_orderkey', count(*) - count(DISTINCT o_orderkey), 0 FROM o
  UNION ALL SELECT 'unique', 'o_custkey', coalesce(sum(n), 0)::BIGINT, 0 FROM d
  UNION ALL SELECT 'duplicate_count', 'o_custkey', count(*), 0 FROM d
  UNION ALL SELECT 'schema', 'o_orderkey', 0, 0
  UNION ALL SELECT 'schema', 'o_totalprice', 1, 0)
SELECT rule, "column", observed, threshold,
       CASE WHEN rule = 'row_count' THEN observed > threshold ELSE observed <= threshold END AS passed
FROM r
""",
)
def dq_range_from_states(spark, sf):
    """A suite over twenty months, answered from the states of all months; one month was added twice."""
    orders = load(spark, sf, "orders")
    month = F.date_format("o_orderdate", "yyyy-MM")
    states = QualityStates(spark, scratch_path(spark, "quality"), ORDER_RULES)
    states.add(orders, month)
    states.add(orders.where(month == MONTHS[0]), month)
    return states.report(*MONTHS)


CHANGED = "o_orderkey % 4000 BETWEEN 100 AND 120"  # orders whose copy in the target differs
LOST = "o_orderkey % 6000 BETWEEN 500 AND 505"
TWICE = "o_orderkey % 9000 BETWEEN 700 AND 702"


def drifted_orders(spark, sf):
    """The orders, and a target in which some are changed, lost or loaded twice."""
    orders = load(spark, sf, "orders")
    target = orders.where(f"NOT ({LOST})").withColumn(
        "o_totalprice", F.when(F.expr(CHANGED), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    return orders, target.unionByName(target.where(TWICE))


@query(
    "compare_by_ranges",
    f"""
WITH target AS (
  SELECT * REPLACE (CASE WHEN {CHANGED} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
  FROM orders WHERE NOT ({LOST})),
b AS (SELECT * FROM target UNION ALL SELECT * FROM target WHERE {TWICE}),
missing AS (SELECT * FROM orders EXCEPT ALL SELECT * FROM b),
extra AS (SELECT * FROM b EXCEPT ALL SELECT * FROM orders)
SELECT 'source' AS side, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, count(*) AS n
FROM missing GROUP BY ALL
UNION ALL
SELECT 'target', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, count(*) FROM extra GROUP BY ALL
""",
)
def compare_by_ranges(spark, sf):
    """What either side has more of, found by descent through fingerprints of key ranges."""
    source, target = drifted_orders(spark, sf)
    rows = fingerprints.compare_by_ranges(source, target, "o_orderkey", fan=64, leaf_rows=500).rows
    more = F.col("copies_a") - F.col("copies_b")
    return rows.select(
        F.when(more > 0, "source").otherwise("target").alias("side"), *source.columns, F.abs(more).alias("n")
    )


RULES = [
    {"rule": "row_count", "above": 0},
    {"rule": "not_null", "column": "c_custkey"},
    {"rule": "matches", "column": "c_mktsegment", "pattern": NAME_PATTERN},
    {"rule": "matches", "column": "c_name", "pattern": NAME_PATTERN},
    {"rule": "max_length", "column": "c_mktsegment", "length": 8},
    {"rule": "unique", "column": "c_custkey"},
    {"rule": "unique", "column": "c_nationkey"},
    {"rule": "duplicate_count", "column": "c_nationkey"},
    {"rule": "schema", "column": "c_custkey", "type": "integer"},
    {"rule": "schema", "column": "c_acctbal", "type": "string"},
]


@query(
    "dq_suite",
    r"""
WITH d AS (SELECT count(*) AS n FROM customer WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey
           HAVING count(*) > 1),
r(rule, "column", observed, threshold) AS (
  SELECT 'row_count', CAST(NULL AS VARCHAR), count(*), 0::BIGINT FROM customer
  UNION ALL SELECT 'not_null', 'c_custkey', count(*) FILTER (c_custkey IS NULL), 0 FROM customer
  UNION ALL SELECT 'matches', 'c_mktsegment',
    count(*) FILTER (NOT regexp_full_match(c_mktsegment, '[A-Za-z\s]+')), 0 FROM customer
  UNION ALL SELECT 'matches', 'c_name',
    count(*) FILTER (NOT regexp_full_match(c_name, '[A-Za-z\s]+')), 0 FROM customer
  UNION ALL SELECT 'max_length', 'c_mktsegment', count(*) FILTER (length(c_mktsegment) > 8), 0 FROM customer
  UNION ALL SELECT 'unique', 'c_custkey', count(*) - count(DISTINCT c_custkey), 0 FROM customer
  UNION ALL SELECT 'unique', 'c_nationkey', coalesce(sum(n), 0)::BIGINT, 0 FROM d
  UNION ALL SELECT 'duplicate_count', 'c_nationkey', count(*), 0 FROM d
  UNION ALL SELECT 'schema', 'c_custkey', 0, 0
  UNION ALL SELECT 'schema', 'c_acctbal', 1, 0)
SELECT rule, "column", observed, threshold,
       CASE WHEN rule = 'row_count' THEN observed > threshold ELSE observed <= threshold END AS passed
FROM r
""",
)
def dq_suite(spark, sf):
    return quality.run_suite(load(spark, sf, "customer"), RULES)


@query(
    "dq_uniqueness",
    """
WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
SELECT count(*) AS groups, coalesce(sum(n), 0)::BIGINT AS rows FROM g
""",
)
def dq_uniqueness(spark, sf):
    return quality.duplicate_stats(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "unique_violations",
    """
WITH a AS (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1),
     b AS (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)
SELECT 'pk_order' AS constraint_name, count(*) AS groups, coalesce(sum(n), 0)::BIGINT AS rows FROM a
UNION ALL SELECT 'uk_customer_date', count(*), coalesce(sum(n), 0)::BIGINT FROM b
""",
)
def unique_violations(spark, sf):
    constraints = {"pk_order": ["o_orderkey"], "uk_customer_date": ["o_custkey", "o_orderdate"]}
    return quality.unique_violations(load(spark, sf, "orders"), constraints)


LABEL_NULLS_SQL = """
WITH j AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT * FROM (
  SELECT 'doc_id' AS column_name, count(*) FILTER (doc_id IS NULL) AS nulls FROM j UNION ALL
  SELECT 'text', count(*) FILTER (text IS NULL) FROM j UNION ALL
  SELECT 'lang', count(*) FILTER (lang IS NULL) FROM j UNION ALL
  SELECT 'source', count(*) FILTER (source IS NULL) FROM j UNION ALL
  SELECT 'n_chars', count(*) FILTER (n_chars IS NULL) FROM j UNION ALL
  SELECT 'quality', count(*) FILTER (quality IS NULL) FROM j UNION ALL
  SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM j)
"""


def labelled_documents(spark, sf):
    return load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id", "left")


@query("null_profile", LABEL_NULLS_SQL)
def null_profile(spark, sf):
    return quality.null_profile(labelled_documents(spark, sf))


@query("columns_without_nulls", f"SELECT column_name FROM ({LABEL_NULLS_SQL}) WHERE nulls = 0")
def columns_without_nulls(spark, sf):
    return quality.columns_without_nulls(labelled_documents(spark, sf))


@query(
    "null_profile_by_type",
    f"SELECT column_name, nulls FROM ({LABEL_NULLS_SQL}) WHERE column_name IN ('text', 'lang', 'source')",
)
def null_profile_by_type(spark, sf):
    return quality.null_profile(labelled_documents(spark, sf), (T.StringType,))


@query(
    "source_target_diff",
    """
SELECT coalesce(s.k, t.k) AS o_orderstatus, coalesce(a, 0) AS source, coalesce(b, 0) AS target,
       coalesce(a, 0) - coalesce(b, 0) AS diff
FROM (SELECT o_orderstatus AS k, count(*) AS a FROM orders GROUP BY 1) s FULL JOIN
     (SELECT CASE WHEN o_totalprice > 300000 THEN 'X' ELSE o_orderstatus END AS k, count(*) AS b
      FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1) t ON s.k = t.k
""",
)
def source_target_diff(spark, sf):
    orders = load(spark, sf, "orders")
    copy = orders.where("o_orderpriority <> '5-LOW'").withColumn(
        "o_orderstatus", F.when(F.col("o_totalprice") > 300000, "X").otherwise(F.col("o_orderstatus"))
    )
    return reconcile.count_difference(orders, copy, "o_orderstatus")


@query(
    "source_target_daily",
    """
SELECT coalesce(s.d, t.d) AS day, coalesce(a, 0) AS source, coalesce(b, 0) AS target,
       coalesce(a, 0) - coalesce(b, 0) AS diff
FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS a FROM orders GROUP BY 1) s FULL JOIN
     (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS b FROM lineitem GROUP BY 1) t ON s.d = t.d
""",
)
def source_target_daily(spark, sf):
    return reconcile.count_difference(
        load(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")),
        load(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day")),
        "day",
    )


@query(
    "metric_difference",
    """
WITH s AS (SELECT count(*)::DOUBLE AS n, round(avg(o_totalprice), 2) AS a, max(o_totalprice) AS m FROM orders),
     t AS (SELECT count(*)::DOUBLE AS n, round(avg(o_totalprice), 2) AS a, max(o_totalprice) AS m FROM orders
           WHERE o_orderstatus <> 'F')
SELECT 'count' AS metric, s.n AS source, t.n AS target, s.n - t.n AS diff FROM s, t
UNION ALL SELECT 'avg', s.a, t.a, round(s.a - t.a, 2) FROM s, t
UNION ALL SELECT 'max', s.m, t.m, round(s.m - t.m, 2) FROM s, t
""",
)
def metric_difference(spark, sf):
    orders = load(spark, sf, "orders")
    total = F.col("o_totalprice")
    compared = reconcile.metric_difference(
        orders,
        orders.where("o_orderstatus <> 'F'"),
        {"count": F.count("*"), "avg": F.round(F.avg(total), 2), "max": F.max(total)},
    )
    return compared.withColumn("diff", F.round("diff", 2))


@query(
    "dq_partition",
    """
WITH p AS (SELECT * FROM orders WHERE year(o_orderdate) = 1995),
     g AS (SELECT count(*) AS n FROM p GROUP BY o_custkey HAVING count(*) > 1)
SELECT 'row_count' AS rule, CAST(NULL AS VARCHAR) AS "column", (SELECT count(*) FROM p) AS observed,
       0::BIGINT AS threshold, (SELECT count(*) FROM p) > 0 AS passed
UNION ALL SELECT 'not_null', 'o_custkey', (SELECT count(*) FROM p WHERE o_custkey IS NULL), 0, true
UNION ALL SELECT 'duplicate_count', 'o_custkey', (SELECT count(*) FROM g), 0, (SELECT count(*) FROM g) = 0
""",
)
def dq_partition(spark, sf):
    """A suite over one partition of the orders."""
    rules = [
        {"rule": "row_count", "above": 0},
        {"rule": "not_null", "column": "o_custkey"},
        {"rule": "duplicate_count", "column": "o_custkey"},
    ]
    return quality.run_suite_on(spark, orders_by_year(spark, sf), "year", "1995", rules)
