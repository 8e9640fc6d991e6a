"""Synthetic data driven by the keys of given tables.

Draws are hashes that SQL cannot repeat, so these queries report properties that SQL can state:
row counts, ranges, allowed values, uniqueness and relations between columns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewell.functions import draws
from tidewell.operators import synth, workload
from tidewell.operators.cdc import apply_changes
from tidewell.operators.customer_image import customer_events, generate_event_files
from tidewell.operators.table_specs import SPECS
from tidewell.plans.registry import load, query
from tidewell.session import scratch_path
from tidewell.sinks import files

AS_OF = dt.datetime(2025, 1, 1)


def order_keys(spark, sf):
    return load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))


def filled(spark, sf, table):
    return synth.fill(synth.spread(order_keys(spark, sf)), SPECS[table], "id", 11, AS_OF)


@query(
    "synth_stock_transactions",
    """
SELECT count(*) AS rows, count(*) AS quantity_in_range, count(*) AS price_in_range, count(*) AS totals_hold,
       count(*) AS settled_after_two_days, count(*) AS ordered_before, count(*) AS expires_after_thirty_days,
       count(*) AS symbols_known, 5::BIGINT AS symbols, count(*) AS keys FROM orders
""",
)
def stock_transactions(spark, sf):
    rows = filled(spark, sf, "stock_transactions")
    trade, ordered = F.col("trade_timestamp"), F.col("order_timestamp")
    hours = (F.unix_seconds(trade.cast("timestamp")) - F.unix_seconds(ordered.cast("timestamp"))) / 3600
    day = F.make_dt_interval(days=F.lit(1))
    symbols = ["AAPL", "GOOGL", "MSFT", "TSLA", "AMZN"]
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("quantity").between(1, 10000)).alias("quantity_in_range"),
        F.count_if(F.col("price_per_share").between(10, 500)).alias("price_in_range"),
        F.count_if(F.col("total_amount") == F.col("quantity") * F.col("price_per_share")).alias("totals_hold"),
        F.count_if(F.col("settlement_date") == trade + day * 2).alias("settled_after_two_days"),
        F.count_if(hours.between(1, 24)).alias("ordered_before"),
        F.count_if(F.col("order_expiry_date") == trade + day * 30).alias("expires_after_thirty_days"),
        F.count_if(F.col("stock_symbol").isin(symbols)).alias("symbols_known"),
        F.count_distinct("stock_symbol").alias("symbols"),
        F.count_distinct("transaction_id").alias("keys"),
    )


@query(
    "synth_cash_transactions",
    """
SELECT count(*) AS rows, count(*) AS totals_hold, count(*) AS settles_in_one_to_three_days,
       count(*) AS uuids, count(*) AS accounts_match FROM orders
""",
)
def cash_transactions(spark, sf):
    rows = filled(spark, sf, "cash_transaction_history")
    total = F.col("quantity") * F.col("price_per_share") + F.col("commission")
    days = F.datediff("settlement_date", "transaction_date")
    uuid = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("total_value") == total).alias("totals_hold"),
        F.count_if(days.between(1, 3)).alias("settles_in_one_to_three_days"),
        F.count_if(F.col("transaction_id").rlike(uuid)).alias("uuids"),
        F.count_if(F.col("account_number").rlike("^ACC[0-9]{6}$")).alias("accounts_match"),
    )


@query(
    "synth_customers",
    """
SELECT count(*) AS rows, count(*) AS ids, count(*) AS accounts, count(*) AS scores_in_range,
       count(*) AS reviews_in_order, true AS half_have_middle_names, true AS tenth_is_closed FROM orders
""",
)
def customers(spark, sf):
    rows = filled(spark, sf, "customer_information")
    n = F.count("*")
    return rows.agg(
        n.alias("rows"),
        F.count_distinct("customer_id").alias("ids"),
        F.count_distinct("account_number").alias("accounts"),
        F.count_if(F.col("credit_score").between(300, 850)).alias("scores_in_range"),
        F.count_if(F.col("next_review_date") > F.col("last_review_date")).alias("reviews_in_order"),
        (F.count("middle_name") / n).between(0.45, 0.55).alias("half_have_middle_names"),
        (F.count("account_close_date") / n).between(0.05, 0.15).alias("tenth_is_closed"),
    )


@query(
    "synth_customers_small",
    """
SELECT count(*) AS rows, count(*) AS codes_match, count(*) AS updated_after_created, 4::BIGINT AS levels
FROM orders
""",
)
def customers_small(spark, sf):
    rows = filled(spark, sf, "customer_information_small")
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("referral_code").rlike("^REF[0-9]{4}$")).alias("codes_match"),
        F.count_if(F.col("updated_at") >= F.col("created_at")).alias("updated_after_created"),
        F.count_distinct("membership_level").alias("levels"),
    )


@query(
    "synth_customer_transactions",
    """
SELECT count(*) AS rows, count(*) AS passports, count(*) AS incomes, count(*) AS future_expiry,
       count(*) AS addresses, 78 AS columns FROM orders
""",
)
def customer_transactions(spark, sf):
    rows = filled(spark, sf, "customer_transactions")
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("passport_number").rlike("^P[0-9]{8}$")).alias("passports"),
        F.count_if(F.col("annual_income").between(0, 99999.99)).alias("incomes"),
        F.count_if(F.col("insurance_expiry_date") > F.lit(AS_OF).cast("date")).alias("future_expiry"),
        F.count_if(F.col("ip_address").rlike(r"^(\d{1,3}\.){3}\d{1,3}$")).alias("addresses"),
        F.lit(len(rows.columns)).alias("columns"),
    )


@query("synth_rows")
def synth_rows(spark, sf):
    """The generated rows themselves."""
    return filled(spark, sf, "cash_transaction_history")


@query(
    "synth_unique_numbers",
    """
SELECT o_orderkey, 'ACC' || CAST((o_orderkey * 1000003) % 900000000000 + 100000000000 AS VARCHAR) AS account
FROM orders
""",
)
def unique_numbers(spark, sf):
    number = draws.unique_number(F.col("o_orderkey"), 10**11, 9 * 10**11, 1_000_003)
    return load(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("ACC"), number.cast("string")).alias("account")
    )


@query(
    "customer_image",
    """
WITH c AS (SELECT c_custkey AS id, 'Customer ' || c_custkey || CASE WHEN c_custkey % 3 = 2 THEN ' New' ELSE '' END
             AS name FROM customer WHERE c_custkey % 3 <> 0)
SELECT id AS customer_id, printf('CUST%07d', id) AS customer_code, name AS full_name,
       CASE WHEN id % 2 = 0 THEN 'M' ELSE 'F' END AS gender, 'TAX' || printf('%08d', id) AS tax_code,
       CASE WHEN id % 5 = 0 THEN 'HIGH' ELSE 'MEDIUM' END AS risk_level, id % 10 = 0 AS vip_flag,
       CAST(DATE '2024-10-01' + CAST(id % 120 AS INT) AS VARCHAR) AS last_trade_date,
       repeat('Customer profile for ' || name || '. Stock company customer record. customer_id=' || id || '. ', 3)
         AS remark,
       'custom-value-' || id || '-7 | Customer profile payload attribute-sequence=7' AS custom_attr_007
FROM c
""",
)
def customer_image(spark, sf):
    """Fields of the after images; the other fields of the wide record are pruned."""
    ids = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    events = customer_events(ids, now=F.lit(AS_OF))
    fields = (
        "customer_id customer_code full_name gender tax_code risk_level vip_flag last_trade_date remark "
        "custom_attr_007"
    ).split()
    return events.where("after IS NOT NULL").select(*[F.col(f"after.{f}").alias(f) for f in fields])


@query(
    "customer_events_updated",
    """
SELECT 'updated_' || c_custkey || '@example.com' AS email, 'HIGH' AS risk_level, 'BATCH_JOB' AS updated_by,
       'customer' || c_custkey || '@example.com' AS old_email,
       CAST(100001000 + c_custkey AS VARCHAR) AS csn FROM customer WHERE c_custkey % 3 = 2
""",
)
def customer_events_updated(spark, sf):
    ids = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    events = customer_events(ids, now=F.lit(AS_OF), rich_updates=True).where("op_type = 'U'")
    return events.select(
        "after.email",
        "after.risk_level",
        "after.updated_by",
        F.col("before.email").alias("old_email"),
        "csn",
    )


@query(
    "customer_event_files",
    "SELECT (4 * ceil(count(*) / 4.0 / 90000))::BIGINT AS files, count(*) AS rows FROM customer",
)
def customer_event_files(spark, sf):
    """Envelopes of all customers, dealt to four tasks, in files of at most 90,000, with their manifest."""
    path = scratch_path(spark, "events")
    ids = load(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    events = customer_events(ids)
    files.write_sized(events, path, 4, files.RECORDS_PER_FILE)
    listed = files.manifest(spark, path, "parquet", AS_OF)
    files.write_manifest(listed, path)
    counted = listed.select(F.lit(1).alias("files"), F.lit(0).alias("rows")).unionByName(
        spark.read.parquet(path).select(F.lit(0).alias("files"), F.lit(1).alias("rows"))
    )
    return counted.agg(F.sum("files").alias("files"), F.sum("rows").alias("rows"))


def customer_workload(spark, sf, pick="random"):
    table = load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    key = F.col("c_custkey")
    changes = {
        "c_mktsegment": F.lit("CHANGED"),
        "c_acctbal": draws.number(draws.draw("balance", key, 5), 1000, 99999, 2).cast("double"),
    }
    return table, workload.change_events(table, "c_custkey", changes, pick=pick, seed=5)


@query(
    "change_workload",
    """
SELECT 'U' AS op_type, 100::BIGINT AS events, 10::BIGINT AS batches, 10::BIGINT AS greatest_batch
UNION ALL SELECT 'D', 10, 10, 1
""",
)
def change_workload(spark, sf):
    _, events = customer_workload(spark, sf)
    per_batch = events.groupBy("op_type", "batch").agg(F.count("*").alias("n"))
    return per_batch.groupBy("op_type").agg(
        F.sum("n").alias("events"),
        F.count("*").alias("batches"),
        F.max("n").alias("greatest_batch"),
    )


@query(
    "change_workload_applied",
    """
WITH first_rows AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS r FROM customer)
SELECT c_custkey, CASE WHEN r <= 100 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment
FROM customer JOIN first_rows USING (c_custkey) WHERE r > 10
""",
)
def change_workload_applied(spark, sf):
    """The first rows updated, some of those deleted, and the log applied to the table."""
    table, events = customer_workload(spark, sf, "first")
    log = events.select(
        "c_custkey",
        F.col("after.c_mktsegment").alias("c_mktsegment"),
        F.col("after.c_acctbal").alias("c_acctbal"),
        "batch",
        F.col("op_type").alias("op"),
    )
    return apply_changes(table, log, "c_custkey", "batch").drop("c_acctbal")


@query(
    "change_log_lines",
    """
SELECT '[DELETE] c_custkey=' || c_custkey AS line, 1::BIGINT AS n
FROM (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 10)
UNION ALL
SELECT '[UPDATE] c_custkey=' || c_custkey || ' | c_mktsegment=CHANGED', 1
FROM (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 100)
""",
)
def change_log_lines(spark, sf):
    """The readable log of a workload over the first rows."""
    _, events = customer_workload(spark, sf, "first")
    lines = workload.log_lines(events, "c_custkey", ["c_mktsegment"])
    return lines.groupBy("line").agg(F.count("*").alias("n"))


@query(
    "generated_event_files",
    """
SELECT 4::BIGINT AS files, 4 * ceil(count(*) / 4.0)::BIGINT AS rows,
       4 * ceil(count(*) / 4.0)::BIGINT AS ids FROM customer
""",
)
def generated_event_files(spark, sf):
    """As many generated customers as the table has, in four files made without a shuffle."""
    path = scratch_path(spark, "generated")
    per_file = -(-load(spark, sf, "customer").count() // 4)
    summary = generate_event_files(spark, path, 4, per_file, run_at=AS_OF)
    ids = F.coalesce("after.customer_id", "before.customer_id")
    rows = spark.read.parquet(path).agg(F.count("*").alias("rows"), F.count_distinct(ids).alias("ids"))
    files_made = summary.first()["actual_file_count"]
    return rows.select(F.lit(files_made).cast("long").alias("files"), "rows", "ids")
