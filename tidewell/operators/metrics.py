"""Run metrics: labelled samples ``(ts, metric, labels MAP, value)`` and task runs."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.clock import duration_seconds, from_seconds, micros, wall_literal
from tidewell.functions.codes import run_status_code, status_text, task_status_code
from tidewell.functions.text import whole_match
from tidewell.operators.keyed import as_list
from tidewell.operators.metric_rules import METRIC_RULES
from tidewell.operators.ranges import key_cuts, range_number

DAY = 86400


def with_labels(samples: DataFrame, names, labels: str = "labels") -> DataFrame:
    """Label values as columns; a label that a sample lacks is NULL."""
    return samples.select(
        *samples.columns, *[F.try_element_at(F.col(labels), F.lit(n)).alias(n) for n in as_list(names)]
    )


def select_samples(
    samples: DataFrame,
    metric: str | None = None,
    equal: dict | None = None,
    match: dict | None = None,
    labels: str = "labels",
) -> DataFrame:
    """Samples of a metric by label: equal to a value, or wholly matching a regex.

    A label that a sample lacks counts as empty text, so ``.*`` keeps the sample.
    """

    def label(name: str) -> Column:
        return F.coalesce(F.try_element_at(F.col(labels), F.lit(name)), F.lit(""))

    if metric is not None:
        samples = samples.where(F.col("metric") == metric)
    for name, value in (equal or {}).items():
        samples = samples.where(label(name) == value)
    for name, pattern in (match or {}).items():
        samples = samples.where(whole_match(label(name), pattern))
    return samples


def _end(samples: DataFrame, as_of: dt.datetime | None) -> Column:
    """The evaluation time: given, or the last sample's time as a scalar subquery."""
    if as_of is not None:
        return wall_literal(as_of)
    return samples.select(F.max("ts")).scalar()


def within(samples: DataFrame, seconds: int, as_of: dt.datetime | None = None) -> DataFrame:
    """Samples of the window ``(as_of - seconds, as_of]``."""
    end = _end(samples, as_of)
    return samples.where((F.col("ts") > end - F.expr(f"INTERVAL '{seconds}' SECOND")) & (F.col("ts") <= end))


def last_over_time(
    samples: DataFrame, series, seconds: int = DAY, as_of: dt.datetime | None = None
) -> DataFrame:
    """``series, ts, value`` of the last non-NULL sample of each series in the window.

    Samples with equal times are ordered by value.
    """
    series = as_list(series)
    recent = within(samples, seconds, as_of).where(F.col("value").isNotNull())
    last = F.max(F.struct("ts", "value"))
    return recent.groupBy(*series).agg(last.alias("_last")).select(*series, "_last.ts", "_last.value")


def last_not_null(samples: DataFrame, series) -> DataFrame:
    """The last non-NULL value of each series, over all time."""
    series = as_list(series)
    last = F.max(F.struct("ts", "value"))
    return (
        samples.where(F.col("value").isNotNull())
        .groupBy(*series)
        .agg(last.alias("_last"))
        .select(*series, F.col("_last.value").alias("value"))
    )


def range_last(samples: DataFrame, series, step: int, lookback: int) -> DataFrame:
    """For a range query: per series and step, the last value within ``lookback`` before the step.

    ``lookback`` is a multiple of ``step`` (seconds). Samples are first reduced to the last of each
    step, combined before the shuffle. Each of those is then given to the steps from its own to the one
    before the series' next sample, so every row made is a row of the result. What is ordered per
    series is one row for each step, however many samples the series has.
    """
    if lookback % step:
        raise ValueError("lookback must be a multiple of step")
    series = as_list(series)
    micro_step = step * 1_000_000
    first_step = F.ceil(micros(F.col("ts")) / F.lit(micro_step)).cast("long")
    reduced = (
        samples.where(F.col("value").isNotNull())
        .groupBy(*series, first_step.alias("_step"))
        .agg(F.max(F.struct("ts", "value")).alias("_last"))
    )
    following = F.lead("_step").over(Window.partitionBy(*series).orderBy("_step"))
    # ``least`` passes over the NULL after a series' last sample.
    end = F.least(F.col("_step") + F.lit(lookback // step - 1), following - 1)
    spread = reduced.withColumn("_end", end).select(
        *series, F.explode(F.sequence("_step", "_end")).alias("_step"), "_last"
    )
    at = from_seconds(F.col("_step") * step)
    return spread.select(*series, at.alias("ts"), F.col("_last.value").alias("value"))


def distinct_series(samples: DataFrame, label: str) -> DataFrame:
    """How many values a label has: one row ``n``."""
    return samples.agg(F.count_distinct(label).alias("n"))


def distinct_series_approx(samples: DataFrame, label: str, error: float = 0.02) -> DataFrame:
    """The same as an estimate with the given relative error."""
    return samples.agg(F.approx_count_distinct(label, error).alias("n"))


def label_values(samples: DataFrame, label: str) -> DataFrame:
    """The values of a label, sorted."""
    return samples.select(label).where(F.col(label).isNotNull()).distinct().orderBy(label)


def max_by_labels(samples: DataFrame, labels) -> DataFrame:
    return samples.groupBy(*as_list(labels)).agg(F.max("value").alias("value"))


def sum_by_labels(samples: DataFrame, labels, where: Column | None = None) -> DataFrame:
    chosen = samples if where is None else samples.where(where)
    return chosen.groupBy(*as_list(labels)).agg(F.sum("value").alias("value"))


def duration_stats(
    samples: DataFrame, series, seconds: int = DAY, as_of: dt.datetime | None = None
) -> DataFrame:
    """Mean and greatest value per series in the window."""
    return (
        within(samples, seconds, as_of)
        .groupBy(*as_list(series))
        .agg(F.avg("value").alias("mean"), F.max("value").alias("max"))
    )


def run_table(
    status: DataFrame, durations: DataFrame, key: str, details=(), seconds: int = DAY, as_of=None
) -> DataFrame:
    """Per id: greatest status value, success and failure totals, last duration in the window.

    ``status`` has ``key, status, value`` and the ``details`` columns; ``durations`` has
    ``key, ts, value``. One pass over the statuses gives all three figures.
    """
    details = as_list(details)

    def total(state: str) -> Column:
        return F.sum(F.when(F.col("status") == state, F.col("value")))

    per_series = status.groupBy(key, *details).agg(
        F.max("value").alias("dag_list"),
        total("success").alias("_success"),
        total("failed").alias("_failed"),
    )
    # Totals per id run over the grouped series, of which an id has few.
    by_id = Window.partitionBy(key)
    table = per_series.select(
        key,
        *details,
        "dag_list",
        F.sum("_success").over(by_id).alias("total_success"),
        F.sum("_failed").over(by_id).alias("total_failed"),
    )
    last = last_over_time(durations, key, seconds, as_of).select(
        key, F.col("value").alias("last_duration")
    )
    return table.join(last, key, "full_outer")


def last_status(samples: DataFrame, key: str) -> DataFrame:
    """Ids with the status whose gauge is one, and its display text."""
    current = samples.groupBy(key, "status").agg(F.max("value").alias("value")).where("value = 1")
    return current.select(key, "status", status_text(F.col("status")).alias("last_status"))


def _chunked(samples: DataFrame, order: list[str], chunks: int | None) -> DataFrame:
    """The samples with a ``_chunk`` number that rises along ``order``.

    The cuts are quantiles of all times, so a chunk holds about an equal share of the samples
    however they are spread over time and series. A time that fills several chunks by itself is
    cut further by quantiles of the second order column, or of a sample of it if that is no number.
    """
    chunks = chunks or 2 * int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares, accuracy = [i / chunks for i in range(1, chunks)] or [0.5], 10 * chunks
    timed = samples.withColumn("_at", micros(F.col(order[0])).cast("double"))
    cuts = timed.agg(F.percentile_approx("_at", shares, accuracy).alias("c")).first()["c"] or [0.0]
    times = sorted(set(cuts))
    splits = [-float("inf"), *times, float("inf")]
    bucketed = Bucketizer(
        splits=splits, inputCol="_at", outputCol="_bucket", handleInvalid="keep"
    ).transform(timed)

    part = F.lit(0)
    full = {time: cuts.count(time) for time in times if cuts.count(time) > 1}
    if full and len(order) > 1 and isinstance(samples.schema[order[1]].dataType, T.NumericType):
        tie = F.col(order[1]).cast("double")
        found = (
            timed.where(F.col("_at").isin(list(full)))
            .groupBy("_at")
            .agg(F.percentile_approx(tie, shares, accuracy).alias("c"))
        )
        for row in found.collect():
            time, parts = row["_at"], full[row["_at"]]
            ties = [row["c"][i * len(row["c"]) // parts] for i in range(1, parts)]
            passed = reduce(Column.__add__, [(tie >= t).cast("int") for t in ties])
            later = (F.col("_bucket") == times.index(time) + 1) & (F.col("_at") > time)
            part = F.when(F.col("_at") == time, passed).when(later, parts).otherwise(part)
    elif full and len(order) > 1:
        for time, parts in full.items():
            ties = key_cuts(timed.where(F.col("_at") == time).select(order[1]), order[1], parts)
            later = (F.col("_bucket") == times.index(time) + 1) & (F.col("_at") > time)
            part = F.when(F.col("_at") == time, range_number(F.col(order[1]), ties)).when(later, parts).otherwise(part)
    number = F.col("_bucket").cast("long") * (chunks + 1) + part
    return bucketed.withColumn("_chunk", number).drop("_at", "_bucket")


def state_intervals(
    samples: DataFrame, series, state: str = "status", order=("ts",), chunks: int | None = None
) -> DataFrame:
    """Runs of equal states: ``series, state, start_ts, end_ts, samples``.

    ``order`` must place the samples of a series uniquely and start with the time. Runs are found
    inside time chunks of about equal size first, so that a series with most of the samples is
    spread over many tasks. Only the first and last run of a chunk can go on in another chunk, and
    only those, at most two per chunk, are put in order per series. By default there are two
    chunks per shuffle partition.
    """
    series, order = as_list(series), as_list(order)
    time = order[0]
    rows = _chunked(samples.select(*series, state, *order), order, chunks)
    inside = Window.partitionBy(*series, "_chunk").orderBy(*order)
    same = F.col(state).eqNullSafe(F.lag(state).over(inside))
    begins = F.when(F.row_number().over(inside) == 1, 1).when(same, 0).otherwise(1)
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.withColumn("_begins", begins).withColumn("_run", F.sum("_begins").over(running))
    runs = numbered.groupBy(*series, "_chunk", "_run").agg(
        F.first(state).alias(state),
        F.min(time).alias("start_ts"),
        F.max(time).alias("end_ts"),
        F.count("*").alias("samples"),
    )
    last_run = F.max("_run").over(Window.partitionBy(*series, "_chunk"))
    runs = runs.withColumn("_edge", (F.col("_run") == 1) | (F.col("_run") == last_run))
    columns = [*series, state, "start_ts", "end_ts", "samples"]
    inner = runs.where("not _edge").select(*columns)
    along = Window.partitionBy(*series).orderBy("_chunk", "_run")
    goes_on = F.col(state).eqNullSafe(F.lag(state).over(along)) & (
        F.lag("_chunk").over(along) != F.col("_chunk")
    )
    edges = runs.where("_edge").withColumn("_new", F.when(goes_on, 0).otherwise(1))
    grouped = edges.withColumn(
        "_group", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0))
    )
    merged = grouped.groupBy(*series, "_group").agg(
        F.first(state).alias(state),
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.sum("samples").alias("samples"),
    )
    return inner.unionByName(merged.select(*columns))


def task_report(runs: DataFrame, dag_id: str, run_id: str) -> DataFrame:
    """Tasks of one run with their duration in seconds, NULL while start or end is missing."""
    return runs.where((F.col("dag_id") == dag_id) & (F.col("run_id") == run_id)).select(
        "task_id",
        "state",
        "start_date",
        "end_date",
        duration_seconds(F.col("start_date"), F.col("end_date")).alias("duration"),
    )


def status_gauges(runs: DataFrame, id_column: str, kind: str = "task", as_of=None) -> DataFrame:
    """One gauge sample per run: its label names are the kind, ``timestamps`` and the id itself.

    A missing state counts as ``unknown``; a missing end takes ``as_of`` or the current time.
    """
    code = {"task": task_status_code, "run": run_status_code}[kind]
    metric, label = {"task": ("TI_stats", "Task"), "run": ("DAG_stats", "DAG")}[kind]
    now = F.localtimestamp() if as_of is None else wall_literal(as_of)
    status = F.coalesce(F.col("state"), F.lit("unknown"))
    at = F.coalesce(F.col("end_date").cast("timestamp_ntz"), now)
    # A run whose id equals a fixed label name keeps the status under that name, as a later label.
    entries = F.map_concat(
        F.map_filter(
            F.create_map(
                F.lit(label), F.col(id_column), F.lit("timestamps"), at.cast("string")
            ),
            lambda k, _: k != F.col(id_column),
        ),
        F.create_map(F.col(id_column), status),
    )
    return runs.select(
        F.lit(metric).alias("metric"),
        F.col(id_column).alias("id"),
        at.alias("ts"),
        status.alias("status"),
        code(status).alias("value"),
        entries.alias("labels"),
    )


def _regex_condition(pattern: str, name: Column) -> Column:
    """The regex test, which for patterns of captures and literals runs on few names only.

    Such a pattern needs each of its literal pieces, and one that begins with a capture can begin
    at the start of the name; both spare the search from every position.
    """
    if not re.fullmatch(r"(?:\(\.\+\)|\\\.|\w)+\$?", pattern):
        return name.rlike(pattern)
    fits = name.rlike(f"^{pattern}" if pattern.startswith("(.+)") else pattern)
    for literal in re.split(r"\(\.\+\)|\\\.|\$", pattern):
        if literal:
            fits = name.contains(literal) & fits
    return fits


def _condition(rule: dict, name: Column, parts: Column) -> Column:
    """Whether a metric name fits a rule. A glob's ``*`` stands for one dotted part."""
    if rule.get("match_type") == "regex":
        return _regex_condition(rule["match"], name)
    pieces = rule["match"].split(".")
    fits = F.size(parts) == len(pieces)
    for i, piece in enumerate(pieces):
        if piece == "*":
            continue
        if "*" in piece:
            glob = "[^.]*".join(re.escape(p) for p in piece.split("*"))
            fits = fits & whole_match(parts[i], glob)
        else:
            fits = fits & (parts[i] == piece)
    return fits


def _label_values(rule: dict, name: Column, parts: Column) -> Column:
    """The label map of a rule; ``$n`` is a capture, other text is itself."""
    stars = [i for i, p in enumerate(rule["match"].split(".")) if p == "*"]
    values = []
    for value in rule["labels"].values():
        capture = re.fullmatch(r"\$(\d+)", value)
        if not capture:
            values.append(F.lit(value))
        elif rule.get("match_type") == "regex":
            values.append(F.regexp_extract(name, rule["match"], int(capture[1])))
        else:
            values.append(parts[stars[int(capture[1]) - 1]])
    return F.map_from_arrays(F.array(*[F.lit(k) for k in rule["labels"]]), F.array(*values))


def map_metric_names(
    df: DataFrame, rules: list[dict] | None = None, column: str = "name", precedence="file"
) -> DataFrame:
    """``metric``, ``kind`` and ``labels`` for each dotted metric name; no rule gives NULLs.

    The first rule that fits wins, in file order or with ``precedence="glob"`` globs before
    regexes. Names are split once, and globs compare parts in place of running regexes.
    """
    rules = list(METRIC_RULES if rules is None else rules)
    if precedence == "glob":
        rules.sort(key=lambda r: r.get("match_type") == "regex")
    name, parts = F.col(column), F.col("_parts")
    which = None
    for i, rule in enumerate(rules):
        fits = _condition(rule, name, parts)
        which = F.when(fits, i) if which is None else which.when(fits, i)
    indexed = df.withColumn("_parts", F.split(name, r"\.", -1)).withColumn("_rule", which)
    position = F.col("_rule") + 1
    labels = None
    for i, rule in enumerate(rules):
        value = _label_values(rule, name, parts)
        labels = F.when(F.col("_rule") == i, value) if labels is None else labels.when(F.col("_rule") == i, value)
    names = F.array(*[F.lit(r["name"]) for r in rules])
    kinds = F.array(*[F.lit(r["kind"]) for r in rules])
    return indexed.select(
        *df.columns,
        F.try_element_at(names, position).alias("metric"),
        F.try_element_at(kinds, position).alias("kind"),
        labels.alias("labels"),
    )


def roll_up(samples: DataFrame, labels, bucket: str = "1 hour", accuracy: int = 10000) -> DataFrame:
    """Per label set and time bucket: counter sum, gauge last, timer count, sum and quantiles.

    ``samples`` has ``ts, kind, value`` and the label columns, with kind counter, gauge or
    observer; the columns of the other kinds are NULL.
    """
    labels = as_list(labels)
    value, kind = F.col("value"), F.col("kind")
    timer = F.when(kind == "observer", value)
    grouped = samples.groupBy(F.window("ts", bucket).alias("_w"), "kind", *labels).agg(
        F.sum(F.when(kind == "counter", value)).alias("counter_sum"),
        F.max(F.when(kind == "gauge", F.struct("ts", "value"))).alias("_last"),
        F.count(timer).alias("timer_count"),
        F.sum(timer).alias("timer_sum"),
        F.percentile_approx(timer, F.array(F.lit(0.5), F.lit(0.99)), accuracy).alias("_q"),
    )
    return grouped.select(
        F.col("_w.start").alias("bucket"),
        "kind",
        *labels,
        "counter_sum",
        F.col("_last.value").alias("gauge_last"),
        "timer_count",
        "timer_sum",
        F.try_element_at("_q", F.lit(1)).alias("timer_p50"),
        F.try_element_at("_q", F.lit(2)).alias("timer_p99"),
    )


# --- roll-ups that merge ---------------------------------------------------------------------------


def sketched_roll_up(
    samples: DataFrame, labels, bucket: str = "1 hour", distinct: str | None = None, accuracy: int = 400, hll_bits: int = 14
) -> DataFrame:
    """``roll_up`` in a form that merges: sums, counts, the last gauge, and sketches in place of quantiles.

    Timers are kept as a quantile sketch (``accuracy`` is its size parameter: the rank error is about 2 divided by it) and the values of
    column ``distinct`` as a distinct sketch of ``2 ** hll_bits`` registers. A sketch's size does not grow with the samples.
    """
    labels = as_list(labels)
    value, kind = F.col("value"), F.col("kind")
    timer = F.when(kind == "observer", value)
    counts = [] if distinct is None else [F.hll_sketch_agg(distinct, F.lit(hll_bits)).alias("distinct_sketch")]
    return samples.groupBy(F.window("ts", bucket).alias("_w"), "kind", *labels).agg(
        F.sum(F.when(kind == "counter", value)).alias("counter_sum"),
        F.max(F.when(kind == "gauge", F.struct("ts", "value"))).alias("gauge_last"),
        F.count(timer).alias("timer_count"),
        F.sum(timer).alias("timer_sum"),
        F.min(timer).alias("timer_min"),
        F.max(timer).alias("timer_max"),
        F.kll_sketch_agg_double(timer, F.lit(accuracy)).alias("timer_sketch"),
        *counts,
    ).select(F.col("_w.start").alias("bucket"), "*").drop("_w")


def merged_roll_up(rolled: DataFrame, labels, bucket: str = "1 day", keep_kind: bool = True) -> DataFrame:
    """Roll-ups of a longer bucket and fewer labels from stored ones, without the samples.

    The same columns come back, so roll-ups merge to any level, in any order.
    """
    labels = as_list(labels)
    keys = [*(["kind"] if keep_kind else []), *labels]
    counts = [F.hll_union_agg("distinct_sketch", F.lit(True)).alias("distinct_sketch")] if "distinct_sketch" in rolled.columns else []
    return rolled.groupBy(F.window("bucket", bucket).alias("_w"), *keys).agg(
        F.sum("counter_sum").alias("counter_sum"),
        F.max("gauge_last").alias("gauge_last"),
        F.sum("timer_count").alias("timer_count"),
        F.sum("timer_sum").alias("timer_sum"),
        F.min("timer_min").alias("timer_min"),
        F.max("timer_max").alias("timer_max"),
        F.kll_merge_agg_double("timer_sketch").alias("timer_sketch"),
        *counts,
    ).select(F.col("_w.start").alias("bucket"), "*").drop("_w")


def read_roll_up(rolled: DataFrame, quantiles=(0.5, 0.99)) -> DataFrame:
    """The figures of mergeable roll-ups: quantiles ``timer_p50`` and so on, the mean, and the number of distinct values."""
    some = F.col("timer_count") > 0
    figures = [
        F.when(some, F.kll_sketch_get_quantile_double("timer_sketch", F.lit(float(q)))).alias(f"timer_p{round(q * 100)}")
        for q in quantiles
    ]
    counts = [F.hll_sketch_estimate("distinct_sketch").alias("distinct")] if "distinct_sketch" in rolled.columns else []
    left = [c for c in rolled.columns if c not in ("timer_sketch", "distinct_sketch", "gauge_last")]
    return rolled.select(
        *left, F.col("gauge_last.value").alias("gauge_last"), (F.col("timer_sum") / F.when(some, F.col("timer_count"))).alias("timer_mean"),
        *figures, *counts,
    )
