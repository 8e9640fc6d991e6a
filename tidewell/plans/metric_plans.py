"""Run-metric queries: events read as gauge samples, orders as task runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewell.functions import codes
from tidewell.functions.clock import duration_seconds
from tidewell.functions.text import rename_by_pattern
from tidewell.operators import metrics, reconcile
from tidewell.operators.metric_rules import METRIC_RULES
from tidewell.plans.registry import load, query
from tidewell.session import staged

# Events become samples of one gauge: the user is the run's id, the event type its status.
STATUS_OF = {"signup": "queued", "purchase": "success", "error": "failed", "click": "running"}
SAMPLES_SQL = """
samples AS (
  SELECT ts, event_id, 'dag_' || user_id AS dag_id,
         CASE event_type WHEN 'signup' THEN 'queued' WHEN 'purchase' THEN 'success'
              WHEN 'error' THEN 'failed' WHEN 'click' THEN 'running' END AS status,
         'host_' || (user_id % 3) AS instance, value
  FROM events)
"""
AS_OF = dt.datetime(2024, 1, 20)


def gauge_samples(spark, sf):
    """``(ts, event_id, metric, labels, value)``; views carry no status label."""
    status = codes.lookup(F.col("event_type"), STATUS_OF)
    labels = F.map_filter(
        F.create_map(
            F.lit("dag_id"),
            F.concat(F.lit("dag_"), F.col("user_id").cast("string")),
            F.lit("status"),
            status,
            F.lit("instance"),
            F.concat(F.lit("host_"), F.pmod("user_id", F.lit(3)).cast("string")),
        ),
        lambda _, v: v.isNotNull(),
    )
    return load(spark, sf, "events").select(
        "ts", "event_id", F.lit("dag_status").alias("metric"), labels.alias("labels"), "value"
    )


def labelled(spark, sf):
    return metrics.with_labels(gauge_samples(spark, sf), ["dag_id", "status", "instance"])


@query("distinct_series", f"WITH {SAMPLES_SQL} SELECT count(DISTINCT dag_id) AS n FROM samples")
def distinct_series(spark, sf):
    return metrics.distinct_series(labelled(spark, sf), "dag_id")


@query(
    "distinct_series_latest",
    f"""
WITH {SAMPLES_SQL}
SELECT count(DISTINCT dag_id) AS n FROM samples
WHERE ts > TIMESTAMP '2024-01-20' - INTERVAL 5 MINUTE AND ts <= TIMESTAMP '2024-01-20'
""",
)
def distinct_series_latest(spark, sf):
    """Ids that have a sample within five minutes of the evaluation time."""
    latest = metrics.last_over_time(labelled(spark, sf), ["dag_id", "status"], 300, AS_OF)
    return metrics.distinct_series(latest, "dag_id")


@query(
    "last_over_time",
    f"""
WITH {SAMPLES_SQL}, recent AS (
  SELECT *, row_number() OVER (PARTITION BY dag_id, status ORDER BY ts DESC, value DESC) AS r
  FROM samples WHERE ts > TIMESTAMP '2024-01-19' AND ts <= TIMESTAMP '2024-01-20')
SELECT dag_id, status, ts, value FROM recent WHERE r = 1
""",
)
def last_over_time(spark, sf):
    return metrics.last_over_time(labelled(spark, sf), ["dag_id", "status"], metrics.DAY, AS_OF)


@query(
    "last_over_time_latest",
    f"""
WITH {SAMPLES_SQL}, recent AS (
  SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY ts DESC, value DESC) AS r
  FROM samples WHERE ts > (SELECT max(ts) FROM samples) - INTERVAL 1 DAY)
SELECT dag_id, ts, value FROM recent WHERE r = 1
""",
)
def last_over_time_latest(spark, sf):
    return metrics.last_over_time(labelled(spark, sf), "dag_id")


@query(
    "last_not_null",
    f"""
WITH {SAMPLES_SQL}
SELECT dag_id, value FROM (
  SELECT dag_id, value, row_number() OVER (PARTITION BY dag_id ORDER BY ts DESC, value DESC) AS r
  FROM samples WHERE status = 'failed') WHERE r = 1
""",
)
def last_not_null(spark, sf):
    samples = labelled(spark, sf).withColumn(
        "value", F.when(F.col("status") == "failed", F.col("value"))
    )
    return metrics.last_not_null(samples, "dag_id")


@query(
    "range_last",
    """
WITH steps AS (
  SELECT CAST(s AS TIMESTAMP) AS ts FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-10',
                                     INTERVAL 6 HOUR) t(s)),
pairs AS (
  SELECT event_type, steps.ts AS ts, value,
         row_number() OVER (PARTITION BY event_type, steps.ts ORDER BY events.ts DESC, value DESC) AS r
  FROM steps JOIN events ON events.ts <= steps.ts AND events.ts > steps.ts - INTERVAL 1 DAY)
SELECT event_type, ts, value FROM pairs WHERE r = 1
""",
)
def range_last(spark, sf):
    return metrics.range_last(load(spark, sf, "events"), "event_type", 6 * 3600, metrics.DAY)


@query(
    "max_by_labels",
    f"WITH {SAMPLES_SQL} SELECT dag_id, instance, max(value) AS value FROM samples GROUP BY ALL",
)
def max_by_labels(spark, sf):
    return metrics.max_by_labels(labelled(spark, sf), ["dag_id", "instance"])


@query(
    "sum_by_status",
    f"""
WITH {SAMPLES_SQL}
SELECT dag_id, round(sum(value), 4) AS value FROM samples WHERE status = 'success' GROUP BY ALL
""",
)
def sum_by_status(spark, sf):
    samples = metrics.select_samples(gauge_samples(spark, sf), "dag_status", {"status": "success"})
    totals = metrics.sum_by_labels(metrics.with_labels(samples, "dag_id"), "dag_id")
    return totals.select("dag_id", F.round("value", 4).alias("value"))


@query(
    "label_filter",
    f"""
WITH {SAMPLES_SQL}
SELECT event_id, dag_id, status FROM samples
WHERE regexp_full_match(dag_id, 'dag_1[0-9]*') AND regexp_full_match(status, 'success|failed|running')
  AND value > 50
""",
)
def label_filter(spark, sf):
    chosen = metrics.select_samples(
        gauge_samples(spark, sf),
        match={"dag_id": "dag_1[0-9]*", "status": "success|failed|running"},
    )
    rows = metrics.with_labels(chosen.where("value > 50"), ["dag_id", "status"])
    return rows.select("event_id", "dag_id", "status")


@query("label_values", f"WITH {SAMPLES_SQL} SELECT DISTINCT dag_id FROM samples")
def label_values(spark, sf):
    return metrics.label_values(labelled(spark, sf), "dag_id")


@query(
    "map_keys",
    f"""
WITH {SAMPLES_SQL}
SELECT 'dag_id' AS key UNION ALL SELECT 'instance' UNION ALL
SELECT DISTINCT 'status' FROM samples WHERE status IS NOT NULL
""",
)
def map_keys(spark, sf):
    from tidewell.operators.nested import distinct_map_keys

    return distinct_map_keys(gauge_samples(spark, sf), "labels")


@query(
    "duration_stats",
    f"""
WITH {SAMPLES_SQL}
SELECT dag_id, round(avg(value), 4) AS mean, max(value) AS max FROM samples
WHERE ts > TIMESTAMP '2024-01-19' AND ts <= TIMESTAMP '2024-01-20' GROUP BY ALL
""",
)
def duration_stats(spark, sf):
    stats = metrics.duration_stats(labelled(spark, sf), "dag_id", metrics.DAY, AS_OF)
    return stats.select("dag_id", F.round("mean", 4).alias("mean"), "max")


@query(
    "run_table",
    f"""
WITH {SAMPLES_SQL}, lists AS (
  SELECT dag_id, instance, max(value) AS dag_list FROM samples GROUP BY ALL),
sums AS (
  SELECT dag_id, round(sum(value) FILTER (status = 'success'), 4) AS total_success,
         round(sum(value) FILTER (status = 'failed'), 4) AS total_failed
  FROM samples GROUP BY ALL),
last AS (
  SELECT dag_id, value AS last_duration FROM (
    SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY ts DESC, value DESC) AS r FROM samples
    WHERE ts > TIMESTAMP '2024-01-19' AND ts <= TIMESTAMP '2024-01-20') WHERE r = 1)
SELECT * FROM lists FULL JOIN sums USING (dag_id) FULL JOIN last USING (dag_id)
""",
)
def run_table(spark, sf):
    samples = labelled(spark, sf)
    table = metrics.run_table(samples, samples, "dag_id", "instance", metrics.DAY, AS_OF)
    rounded = {c: F.round(c, 4) for c in ("total_success", "total_failed")}
    return table.withColumns(rounded)


@query(
    "last_status",
    f"""
WITH {SAMPLES_SQL}, last AS (
  SELECT dag_id, status, event_id,
         max(event_id) OVER (PARTITION BY dag_id) = event_id AS is_last FROM samples)
SELECT dag_id, status, CASE status WHEN 'failed' THEN 'Failed' WHEN 'queued' THEN 'Queued'
       WHEN 'running' THEN 'Running' WHEN 'success' THEN 'Success' ELSE 'No Status' END AS last_status
FROM last WHERE is_last
""",
)
def last_status(spark, sf):
    """A one-or-zero gauge per id and status, set for the id's last event."""
    rows = labelled(spark, sf).groupBy("dag_id", "status").agg(F.max("event_id").alias("seen"))
    newest = rows.groupBy(F.col("dag_id").alias("_d")).agg(F.max("seen").alias("_n"))
    gauge = rows.join(newest, F.col("dag_id") == F.col("_d")).select(
        "dag_id", "status", (F.col("seen") == F.col("_n")).cast("double").alias("value")
    )
    return metrics.last_status(gauge, "dag_id")


@query(
    "status_timeline",
    f"""
WITH {SAMPLES_SQL}, day AS (
  SELECT * FROM samples WHERE status IN ('success', 'failed', 'running') AND value > 0
    AND ts > TIMESTAMP '2024-01-19' AND ts <= TIMESTAMP '2024-01-20'),
marked AS (
  SELECT *, CASE WHEN status = lag(status) OVER w THEN 0 ELSE 1 END AS new FROM day
  WINDOW w AS (PARTITION BY dag_id ORDER BY ts, event_id)),
runs AS (
  SELECT *, sum(new) OVER (PARTITION BY dag_id ORDER BY ts, event_id) AS run FROM marked)
SELECT dag_id, status, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS samples
FROM runs GROUP BY dag_id, status, run
""",
)
def status_timeline(spark, sf):
    shown = metrics.select_samples(
        gauge_samples(spark, sf), match={"status": "success|failed|running"}
    ).where("value > 0")
    day = metrics.with_labels(metrics.within(shown, metrics.DAY, AS_OF), ["dag_id", "status"])
    return metrics.state_intervals(day, "dag_id", "status", ["ts", "event_id"])


@query(
    "state_intervals",
    """
WITH marked AS (
  SELECT *, CASE WHEN event_type = lag(event_type) OVER (ORDER BY ts, event_id) THEN 0 ELSE 1 END AS new
  FROM events),
runs AS (SELECT *, sum(new) OVER (ORDER BY ts, event_id) AS run FROM marked)
SELECT 'all' AS series, event_type, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS samples
FROM runs GROUP BY event_type, run
""",
)
def state_intervals(spark, sf):
    """One series that holds every event, the worst case for a window per series."""
    rows = load(spark, sf, "events").withColumn("series", F.lit("all"))
    return metrics.state_intervals(rows, "series", "event_type", ["ts", "event_id"])


# Every rule name is hit, and some names fit none or two rules.
NAMES = [
    rule["match"].replace(r"(.+)\.(.+)_start$", "env.job_start")
    .replace(r"(.+)\.(.+)_end$", "env.job_end")
    .replace(r"(.+)\.operator_failures_(.+)$", "env.operator_failures_Bash")
    .replace(r"(.+)\.operator_successes_(.+)$", "env.operator_successes_Bash")
    .replace("*", "part")
    for rule in METRIC_RULES
] + ["env.ti.start.dagA.my_start", "no_rule_at_all", "env.unknown.metric"]
NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"


def _rule_regex(rule):
    if rule["match_type"] == "regex":
        return "^" + rule["match"]
    return "^" + rule["match"].replace(".", r"\.").replace("*", "([^.]*)") + "$"


def _case(pick):
    whens = " ".join(
        f"WHEN regexp_matches(name, '{_rule_regex(r)}') THEN {pick(r)}" for r in METRIC_RULES
    )
    return f"CASE {whens} END"


def _label(i):
    return _case(
        lambda r: f"regexp_extract(name, '{_rule_regex(r)}', {i})" if len(r["labels"]) >= i else "NULL"
    )


@query(
    "metric_mapping",
    f"""
WITH names AS (
  SELECT event_id, replace(list_extract({NAMES_SQL}, CAST(event_id % {len(NAMES)} AS INT) + 1),
                           'part', 'u' || user_id) AS name FROM events),
mapped AS (
  SELECT name, {_case(lambda r: "'" + r["name"] + "'")} AS metric,
         {_case(lambda r: "'" + r["kind"] + "'")} AS kind,
         {_label(1)} AS label_1, {_label(2)} AS label_2, {_label(3)} AS label_3, {_label(4)} AS label_4
  FROM names)
SELECT metric, kind, label_1, label_2, label_3, label_4, count(*) AS n FROM mapped GROUP BY ALL
""",
)
def metric_mapping(spark, sf):
    names = F.array(*[F.lit(n) for n in NAMES])
    position = (F.pmod("event_id", F.lit(len(NAMES))) + 1).cast("int")
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    rows = load(spark, sf, "events").select(
        F.replace(F.element_at(names, position), F.lit("part"), user).alias("name")
    )
    mapped = metrics.map_metric_names(rows)
    values = F.map_values("labels")
    return mapped.groupBy(
        "metric",
        "kind",
        *[F.try_element_at(values, F.lit(i)).alias(f"label_{i}") for i in range(1, 5)],
    ).agg(F.count("*").alias("n"))


@query(
    "metric_mapping_globs_first",
    """
SELECT CAST(event_id % 2 AS INT) AS k,
       CASE WHEN event_id % 2 = 0 THEN 'af_agg_ti_start' ELSE 'af_agg_job_start' END AS metric,
       count(*) AS n FROM events GROUP BY ALL
""",
)
def metric_mapping_globs_first(spark, sf):
    """A name that fits a regex and a glob goes to the glob when globs come first."""
    k = F.pmod("event_id", F.lit(2)).cast("int")
    name = F.when(k == 0, "env.ti.start.dagA.my_start").otherwise("env.my_start")
    rows = load(spark, sf, "events").select(k.alias("k"), name.alias("name"))
    mapped = metrics.map_metric_names(rows, precedence="glob")
    return mapped.groupBy("k", "metric").agg(F.count("*").alias("n"))


@query(
    "status_codes",
    """
SELECT event_type, CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 4
       ELSE 0 END AS task_code,
       CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'error' THEN 3 ELSE 0 END
         AS run_code, count(*) AS n
FROM events GROUP BY ALL
""",
)
def status_codes(spark, sf):
    states = {"signup": "success", "purchase": "failed", "error": "running", "view": "lost"}
    state = codes.lookup(F.col("event_type"), states)
    return (
        load(spark, sf, "events")
        .groupBy(
            "event_type",
            codes.task_status_code(state).alias("task_code"),
            codes.run_status_code(state).alias("run_code"),
        )
        .agg(F.count("*").alias("n"))
    )


@query(
    "status_text",
    f"""
WITH {SAMPLES_SQL}
SELECT CASE status WHEN 'failed' THEN 'Failed' WHEN 'queued' THEN 'Queued' WHEN 'running' THEN 'Running'
       WHEN 'success' THEN 'Success' ELSE 'No Status' END AS text, count(*) AS n
FROM samples GROUP BY ALL
""",
)
def status_text(spark, sf):
    rows = labelled(spark, sf).select(codes.status_text(F.col("status")).alias("text"))
    return rows.groupBy("text").agg(F.count("*").alias("n"))


@query(
    "threshold_bands",
    """
SELECT s_suppkey, CASE WHEN s_acctbal >= 1 THEN 'red' WHEN s_acctbal >= 0 THEN 'orange' ELSE 'green' END
  AS band FROM supplier
""",
)
def threshold_bands(spark, sf):
    return load(spark, sf, "supplier").select(
        "s_suppkey", codes.band(F.col("s_acctbal")).alias("band")
    )


def task_runs(spark, sf):
    """Orders as task runs: the customer is the run, the order its task, priorities give the end."""
    days = F.substring("o_orderpriority", 1, 1).cast("int")
    return load(spark, sf, "orders").select(
        F.lit("orders").alias("dag_id"),
        F.concat(F.lit("run_"), F.col("o_custkey").cast("string")).alias("run_id"),
        F.concat(F.lit("task_"), F.col("o_orderkey").cast("string")).alias("task_id"),
        F.when(F.col("o_orderstatus") == "F", "success")
        .when(F.col("o_orderstatus") == "O", "running")
        .alias("state"),
        F.col("o_orderdate").alias("start_date"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.make_dt_interval(days=days))
        .alias("end_date"),
    )


@query(
    "task_report",
    """
SELECT 'task_' || o_orderkey AS task_id,
       CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'running' END AS state,
       CASE WHEN o_orderstatus = 'F' THEN substr(o_orderpriority, 1, 1)::DOUBLE * 86400 END AS duration
FROM orders WHERE o_custkey = 7
""",
)
def task_report(spark, sf):
    report = metrics.task_report(task_runs(spark, sf), "orders", "run_7")
    return report.select("task_id", "state", "duration")


@query(
    "run_durations",
    """
SELECT 'run_' || o_custkey AS run_id, count(*) AS tasks,
       sum(CASE WHEN o_orderstatus = 'F' THEN substr(o_orderpriority, 1, 1)::DOUBLE * 86400 END) AS seconds
FROM orders GROUP BY ALL
""",
)
def run_durations(spark, sf):
    return (
        task_runs(spark, sf)
        .groupBy("run_id")
        .agg(
            F.count("*").alias("tasks"),
            F.sum(duration_seconds(F.col("start_date"), F.col("end_date"))).alias("seconds"),
        )
    )


@query(
    "status_gauges",
    """
SELECT 'task_' || o_orderkey AS id, 'TI_stats' AS metric,
       CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'running' ELSE 'unknown' END AS status,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 4 ELSE 0 END AS value, 3 AS labels,
       CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'running' ELSE 'unknown' END AS own_label
FROM orders
""",
)
def status_gauges(spark, sf):
    gauges = metrics.status_gauges(task_runs(spark, sf), "task_id", "task", AS_OF)
    return gauges.select(
        "id",
        "metric",
        "status",
        "value",
        F.size("labels").alias("labels"),
        F.try_element_at("labels", F.col("id")).alias("own_label"),
    )


ROLL_SQL = """
WITH s AS (
  SELECT date_trunc('hour', ts) AS bucket, ts, value, event_type,
         CASE event_type WHEN 'click' THEN 'counter' WHEN 'view' THEN 'counter' WHEN 'signup' THEN 'gauge'
              ELSE 'observer' END AS kind FROM events)
SELECT bucket, kind, event_type, round(sum(value) FILTER (kind = 'counter'), 4) AS counter_sum,
       (max({'t': ts, 'v': value}) FILTER (kind = 'gauge')).v AS gauge_last,
       count(*) FILTER (kind = 'observer') AS timer_count,
       round(sum(value) FILTER (kind = 'observer'), 4) AS timer_sum,
       quantile_disc(value, 0.5) FILTER (kind = 'observer') AS timer_p50,
       quantile_disc(value, 0.99) FILTER (kind = 'observer') AS timer_p99
FROM s GROUP BY bucket, kind, event_type
"""


def kind_of(event_type):
    return (
        F.when(event_type.isin("click", "view"), "counter")
        .when(event_type == "signup", "gauge")
        .otherwise("observer")
    )


@query("metric_roll_up", ROLL_SQL)
def metric_roll_up(spark, sf):
    samples = load(spark, sf, "events").withColumn("kind", kind_of(F.col("event_type")))
    rolled = metrics.roll_up(samples, "event_type", "1 hour")
    return rolled.withColumns(
        {c: F.round(c, 4) for c in ("counter_sum", "timer_sum")}
    )


@query(
    "metric_sketch_merge",
    """
WITH s AS (
  SELECT date_trunc('day', ts) AS bucket, event_type, user_id, value,
         CASE WHEN event_type IN ('click', 'view') THEN 'counter' WHEN event_type = 'signup' THEN 'gauge' ELSE 'observer' END AS kind
  FROM events)
SELECT bucket, kind, count(*) FILTER (kind = 'observer') AS timer_count,
       round(sum(value) FILTER (kind = 'counter'), 4) AS counter_sum,
       round(sum(value) FILTER (kind = 'observer'), 4) AS timer_sum,
       min(value) FILTER (kind = 'observer') AS timer_min, max(value) FILTER (kind = 'observer') AS timer_max,
       CASE WHEN kind = 'observer' THEN true END AS p50_fits, CASE WHEN kind = 'observer' THEN true END AS p99_fits,
       true AS distinct_fits
FROM s GROUP BY bucket, kind
""",
)
def metric_sketch_merge(spark, sf):
    """Days over all event types from stored hours of each type. Quantiles must lie within a hundredth of their rank, numbers
    of distinct users within a twentieth; both are held against the samples."""
    samples = load(spark, sf, "events").withColumn("kind", kind_of(F.col("event_type")))
    hours = staged(metrics.sketched_roll_up(samples, "event_type", "1 hour", distinct="user_id"), "hours")
    days = metrics.read_roll_up(metrics.merged_roll_up(hours, [], "1 day"))
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("bucket")
    timed = F.col("kind") == "observer"
    met = samples.select(day, "kind", "value", "user_id").join(days.select("bucket", "kind", "timer_p50", "timer_p99"), ["bucket", "kind"])
    exact = met.groupBy("bucket", "kind").agg(
        *[F.avg((F.col("value") < F.col(f"timer_p{p}")).cast("int")).alias(f"below{p}") for p in (50, 99)],
        *[F.avg((F.col("value") <= F.col(f"timer_p{p}")).cast("int")).alias(f"upto{p}") for p in (50, 99)],
        F.count_distinct("user_id").alias("users"),
    )

    def fits(p):
        near = (F.col(f"below{p}") <= p / 100 + 0.01) & (F.col(f"upto{p}") >= p / 100 - 0.01)
        return F.when(timed, near).alias(f"p{p}_fits")

    return days.join(exact, ["bucket", "kind"]).select(
        "bucket", "kind", "timer_count", *[F.round(c, 4).alias(c) for c in ("counter_sum", "timer_sum")], "timer_min", "timer_max",
        fits(50), fits(99), (F.abs(F.col("distinct") - F.col("users")) <= 0.05 * F.col("users")).alias("distinct_fits"),
    )


@query(
    "tumbling_rollup",
    """
SELECT date_trunc('hour', ts) AS bucket, event_type, count(*) AS n, round(sum(value), 4) AS total
FROM events GROUP BY ALL
""",
)
def tumbling_rollup(spark, sf):
    return (
        load(spark, sf, "events")
        .groupBy(F.window("ts", "1 hour").alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
        .select(F.col("w.start").alias("bucket"), "event_type", "n", "total")
    )


@query(
    "merge_side_by_side",
    """
SELECT coalesce(a.k, b.k) AS c_custkey, balance, spent FROM
 (SELECT c_custkey AS k, c_acctbal AS balance FROM customer WHERE c_acctbal > 0) a FULL JOIN
 (SELECT o_custkey AS k, CAST(count(*) AS DOUBLE) AS spent FROM orders GROUP BY 1) b ON a.k = b.k
""",
)
def merge_side_by_side(spark, sf):
    balance = load(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey", "c_acctbal")
    spent = (
        load(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n"))
    )
    return reconcile.side_by_side({"balance": (balance, "c_acctbal"), "spent": (spent, "n")}, "c_custkey")


@query(
    "rename_by_regex",
    f"""
WITH {SAMPLES_SQL}
SELECT dag_id, count(*) FILTER (status = 'success') AS "TOTAL_SUCCESS",
       count(*) FILTER (status = 'failed') AS "TOTAL_FAILED" FROM samples GROUP BY dag_id
""",
)
def rename_by_regex(spark, sf):
    counts = (
        labelled(spark, sf)
        .groupBy("dag_id")
        .agg(
            F.count_if(F.col("status") == "success").alias("Value #TOTAL_SUCCESS"),
            F.count_if(F.col("status") == "failed").alias("Value #TOTAL_FAILED"),
        )
    )
    return rename_by_pattern(counts, r"^Value #([A-Z_]+)$", "$1")


@query(
    "run_gauges",
    """
SELECT 'run_' || o_custkey AS id, 'DAG_stats' AS metric, count(*) AS tasks,
       max(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 3 ELSE 0 END) AS value
FROM orders GROUP BY ALL
""",
)
def run_gauges(spark, sf):
    """Gauges with the codes of whole runs."""
    gauges = metrics.status_gauges(task_runs(spark, sf), "run_id", "run", AS_OF)
    return gauges.groupBy("id", "metric").agg(
        F.count("*").alias("tasks"), F.max("value").alias("value")
    )
