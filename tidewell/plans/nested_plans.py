"""Nested-data, scalar and projection queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewell.functions import clock, numbers, text
from tidewell.operators import nested
from tidewell.plans.registry import load, query


def nested_events(spark, sf):
    """Events with a struct in a struct, an array of structs, and two maps."""
    return load(spark, sf, "events").select(
        "event_id",
        F.struct(
            F.col("user_id").alias("user"),
            F.struct(F.col("event_type").alias("kind"), F.col("value").alias("value")).alias("what"),
        ).alias("s"),
        F.from_json("props", "map<string,long>").alias("props"),
        F.create_map(F.col("event_type"), F.col("user_id")).alias("users"),
    )


@query(
    "flatten_struct",
    """
SELECT event_id, user_id AS s_user, event_type AS s_what_kind, value AS s_what_value FROM events
""",
)
def flatten_struct(spark, sf):
    rows = nested_events(spark, sf).select("event_id", "s")
    return nested.flatten(rows, max_keys=1_000)


@query(
    "flatten_array_explode",
    "SELECT vec_id, label, unnest(embedding) AS embedding FROM embeddings",
)
def flatten_array_explode(spark, sf):
    return nested.explode_arrays(load(spark, sf, "embeddings"))


ARRAY_SQL = """
SELECT doc_id, source, x AS token FROM (
  SELECT doc_id, source, unnest(CASE WHEN lang = 'en' THEN str_split(source, '_') {other} END) AS x
  FROM documents)
"""


def source_tokens(spark, sf):
    parts = F.when(F.col("lang") == "en", F.split("source", "_"))
    return load(spark, sf, "documents").select("doc_id", "source", parts.alias("token"))


@query("flatten_array_drops_null", ARRAY_SQL.format(other=""))
def flatten_array_drops_null(spark, sf):
    return nested.explode_arrays(source_tokens(spark, sf))


@query("flatten_array_outer", ARRAY_SQL.format(other="ELSE [NULL]"))
def flatten_array_outer(spark, sf):
    return nested.explode_arrays(source_tokens(spark, sf), mode="outer")


@query(
    "flatten_map_keys",
    """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CASE WHEN event_type = 'click' THEN user_id END AS click,
       CASE WHEN event_type = 'error' THEN user_id END AS error,
       CASE WHEN event_type = 'purchase' THEN user_id END AS purchase,
       CASE WHEN event_type = 'signup' THEN user_id END AS signup,
       CASE WHEN event_type = 'view' THEN user_id END AS view
FROM events
""",
)
def flatten_map_keys(spark, sf):
    return nested.map_keys_as_columns(nested_events(spark, sf).drop("s"), max_keys=1_000)


@query(
    "flatten_map_rows",
    """
SELECT event_id, 'k' AS props_key, CAST(json_extract(props, '$.k') AS BIGINT) AS props_value,
       event_type AS users_key, user_id AS users_value FROM events
""",
)
def flatten_map_rows(spark, sf):
    return nested.explode_maps(nested_events(spark, sf).drop("s"))


@query(
    "flatten_all",
    """
SELECT event_id, x.items AS items_at, x.m AS items_n, CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM (SELECT event_id, props, unnest([{'items': event_type, 'm': value}, {'items': 'total', 'm': value + 1}])
      AS x FROM events)
""",
)
def flatten_all(spark, sf):
    def item(at, n):
        return F.struct(at.alias("at"), n.alias("n"))

    value = F.col("value")
    rows = load(spark, sf, "events").select(
        "event_id",
        F.array(item(F.col("event_type"), value), item(F.lit("total"), value + 1)).alias("items"),
        F.from_json("props", "map<string,long>").alias("props"),
    )
    return nested.flatten(rows, max_keys=1_000)


@query(
    "wall_clock_nested",
    """
SELECT o_orderkey, o_orderdate AS top, o_orderdate AS in_struct, o_orderdate AS in_array,
       o_orderdate AS in_map FROM orders
""",
)
def wall_clock_nested(spark, sf):
    """Order dates written with an offset at four depths and converted in place."""
    stamp = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+07:00"))
    rows = load(spark, sf, "orders").select(
        "o_orderkey",
        stamp.alias("at"),
        F.struct(stamp.alias("at")).alias("s"),
        F.array(F.struct(stamp.alias("at"))).alias("a"),
        F.create_map(F.lit("k"), F.struct(stamp.alias("at"))).alias("m"),
    )
    done = nested.convert_wall_clock(nested.tag_zoned(rows, ["at"]), ["s.at", "a[].at", "m[].at"])
    return done.select(
        "o_orderkey",
        F.col("at").alias("top"),
        F.col("s.at").alias("in_struct"),
        F.col("a")[0]["at"].alias("in_array"),
        F.col("m")["k"]["at"].alias("in_map"),
    )


@query(
    "wide_decimal_bytes",
    """
SELECT c_custkey, CASE WHEN c_custkey = 0 THEN '0.00' ELSE CASE WHEN c_custkey % 2 = 0 THEN '-' ELSE '' END
       || c_custkey || '0000000000000000000000000000000000000000.00' END AS amount FROM customer
""",
)
def wide_decimal_bytes(spark, sf):
    """Amounts of more than 40 digits, carried as two's complement bytes."""
    scale = 10**42

    @F.pandas_udf("binary")
    def encode(values):
        return values.map(
            lambda v: (int(v) * scale * (-1 if v % 2 == 0 else 1)).to_bytes(32, "big", signed=True)
        )

    rows = load(spark, sf, "customer").select("c_custkey", encode("c_custkey").alias("raw"))
    return rows.select("c_custkey", nested.decode_wide_decimal(F.col("raw"), 2).alias("amount"))


@query(
    "decimal_to_string",
    """
SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS balance, c_mktsegment FROM customer
""",
)
def decimal_to_string(spark, sf):
    rows = load(spark, sf, "customer").select(
        "c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("balance"), "c_mktsegment"
    )
    return numbers.decimals_to_text(rows)


@query(
    "projection",
    "SELECT s_name AS \"Supplier\", s_suppkey AS \"Supplier ID\", s_acctbal * 2 AS s_acctbal FROM supplier",
)
def projection(spark, sf):
    return (
        load(spark, sf, "supplier")
        .drop("s_nationkey")
        .withColumn("s_acctbal", F.col("s_acctbal") * 2)
        .withColumnsRenamed({"s_name": "Supplier", "s_suppkey": "Supplier ID"})
        .select("Supplier", "Supplier ID", "s_acctbal")
    )


@query(
    "text_functions",
    """
SELECT c_custkey, 'TAX' || printf('%08d', c_custkey) AS padded, printf('CUST%07d', c_custkey) AS code,
       substr(c_name, 1, 8) AS cut, repeat(c_mktsegment, 3) AS thrice,
       replace(c_mktsegment, 'I', ' ') AS one_line, contains(upper(c_name), 'CUSTOMER') AS found,
       concat_ws('|', c_name, c_mktsegment) AS joined,
       regexp_full_match(c_mktsegment, '[A-Z]{8}') AS eight
FROM customer
""",
)
def text_functions(spark, sf):
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    broken = F.replace(segment, F.lit("I"), F.lit("\n"))
    return load(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit("TAX"), text.zero_padded(key, 8)).alias("padded"),
        text.prefixed("CUST", key, 7).alias("code"),
        F.substring("c_name", 1, 8).alias("cut"),
        F.repeat(segment, 3).alias("thrice"),
        text.one_line(broken).alias("one_line"),
        text.contains_any_case(F.col("c_name"), "customer").alias("found"),
        F.concat_ws("|", "c_name", "c_mktsegment").alias("joined"),
        text.whole_match(segment, "[A-Z]{8}").alias("eight"),
    )


@query(
    "null_text_rules",
    """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_name || '-' || c_mktsegment END AS by_concat,
       concat_ws('-', CASE WHEN c_acctbal > 0 THEN c_name END, c_mktsegment) AS by_concat_ws
FROM customer
""",
)
def null_text_rules(spark, sf):
    """``concat`` gives NULL for a NULL part, ``concat_ws`` leaves the part out."""
    name = F.when(F.col("c_acctbal") > 0, F.col("c_name"))
    return load(spark, sf, "customer").select(
        "c_custkey",
        F.concat(name, F.lit("-"), F.col("c_mktsegment")).alias("by_concat"),
        F.concat_ws("-", name, "c_mktsegment").alias("by_concat_ws"),
    )


@query(
    "regex_capture",
    r"""
SELECT item, count(*) AS n FROM (
  SELECT regexp_extract(url, '^https?://([^/]+)/', 1) AS item FROM pages) GROUP BY ALL
""",
)
def regex_capture(spark, sf):
    host = F.regexp_extract("url", r"^https?://([^/]+)/", 1)
    return load(spark, sf, "pages").groupBy(host.alias("item")).agg(F.count("*").alias("n"))


@query(
    "time_functions",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS DATE) + 30 AS expiry,
       o_orderdate + INTERVAL 2 DAY AS settles, o_orderdate - INTERVAL 5 HOUR AS ordered,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z' AS iso,
       DATE '2024-10-01' + CAST(o_orderkey % 120 AS INT) AS cycled
FROM orders
""",
)
def time_functions(spark, sf):
    day = F.col("o_orderdate")
    return load(spark, sf, "orders").select(
        "o_orderkey",
        F.to_date(day).alias("day"),
        F.date_add(day.cast("date"), 30).alias("expiry"),
        clock.add_days(day, F.lit(2)).alias("settles"),
        clock.add_hours(day, F.lit(-5)).alias("ordered"),
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"),
        clock.cycling_date(F.col("o_orderkey"), "2024-10-01", 120).alias("cycled"),
    )


@query(
    "parse_timestamps",
    """
SELECT event_id, ts AS parsed, strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS iso FROM events
""",
)
def parse_timestamps(spark, sf):
    written = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    parsed = clock.parse_event_ts(written)
    return load(spark, sf, "events").select(
        "event_id", parsed.cast("timestamp_ntz").alias("parsed"), clock.iso_offset(parsed).alias("iso")
    )


@query(
    "long_fraction_timestamps",
    "SELECT event_id, date_trunc('second', ts) + INTERVAL 328488 MICROSECOND AS parsed FROM events",
)
def long_fraction_timestamps(spark, sf):
    """Seven fractional digits: the seventh is cut."""
    written = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(".3284886"))
    return load(spark, sf, "events").select("event_id", clock.event_ts(written).alias("parsed"))


@query(
    "money_totals",
    """
SELECT l_orderkey, l_linenumber,
       CAST(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(28,2))::DOUBLE
         AS trade,
       (CAST(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(28,2))
        + CAST(l_tax AS DECIMAL(18,2)))::DOUBLE AS cash,
       round(l_extendedprice / 1048576, 2) AS mb
FROM lineitem
""",
)
def money_totals(spark, sf):
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    return load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.trade_total(quantity, price).cast("double").alias("trade"),
        numbers.cash_total(quantity, price, F.col("l_tax")).cast("double").alias("cash"),
        numbers.megabytes(price).alias("mb"),
    )


@query(
    "dirty_casts",
    """
SELECT p_partkey, TRY_CAST(substr(p_name, 1, 1) AS INT) AS digit, CAST(p_size AS VARCHAR) AS size_text,
       TRY_CAST(regexp_extract(p_brand, '#(.*)$', 1) AS BIGINT) AS brand
FROM part
""",
)
def dirty_casts(spark, sf):
    return load(spark, sf, "part").select(
        "p_partkey",
        F.substring("p_name", 1, 1).try_cast("int").alias("digit"),
        F.col("p_size").cast("string").alias("size_text"),
        F.regexp_extract("p_brand", "#(.*)$", 1).try_cast("bigint").alias("brand"),
    )


@query(
    "json_documents",
    """
SELECT c_custkey, '{"id":' || c_custkey || ',"name":"' || c_name || '","nation":' || c_nationkey || '}' AS doc
FROM customer
""",
)
def json_documents(spark, sf):
    document = F.to_json(
        F.struct(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").alias("nation"),
        )
    )
    return load(spark, sf, "customer").select("c_custkey", document.alias("doc"))


@query(
    "variant_fields",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events",
)
def variant_fields(spark, sf):
    return load(spark, sf, "events").select(
        "event_id", F.variant_get(F.parse_json("props"), "$.k", "int").alias("k")
    )


@query(
    "filter_day",
    """
SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1995-03-15'
""",
)
def filter_day(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return rows.where(clock.on_day(F.col("o_orderdate"), dt.date(1995, 3, 15)))


@query(
    "filter_text",
    """
SELECT p_partkey, p_type FROM part
WHERE starts_with(p_type, 'S') AND ends_with(p_type, 'L') OR p_name IS NULL
""",
)
def filter_text(spark, sf):
    kind = F.col("p_type")
    wanted = (kind.startswith("S") & kind.endswith("L")) | F.col("p_name").isNull()
    return load(spark, sf, "part").where(wanted).select("p_partkey", "p_type")


@query(
    "drop_null_rows",
    """
SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE quality IS NOT NULL AND toxic IS NOT NULL
""",
)
def drop_null_rows(spark, sf):
    joined = load(spark, sf, "documents").select("doc_id").join(
        load(spark, sf, "labels"), "doc_id", "left"
    )
    return joined.na.drop(subset=["quality", "toxic"]).select("doc_id", "quality")


@query(
    "having_count",
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 20",
)
def having_count(spark, sf):
    return (
        load(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).where("n > 20")
    )


@query(
    "distinct_counts",
    """
SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, count(*) AS rows
FROM lineitem
""",
)
def distinct_counts(spark, sf):
    return load(spark, sf, "lineitem").agg(
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.count("*").alias("rows"),
    )


@query(
    "union_all",
    """
SELECT c_nationkey AS nation, 'c' AS kind FROM customer UNION ALL SELECT s_nationkey, 's' FROM supplier
""",
)
def union_all(spark, sf):
    customers = load(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation"), F.lit("c").alias("kind")
    )
    return customers.union(load(spark, sf, "supplier").select("s_nationkey", F.lit("s")))


@query(
    "sorted_distinct",
    "SELECT DISTINCT p_brand FROM part ORDER BY p_brand",
)
def sorted_distinct(spark, sf):
    return load(spark, sf, "part").select("p_brand").distinct().orderBy("p_brand")
