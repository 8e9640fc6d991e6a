"""URL filters by a temporal list join: every capture against the list entries of its fetch time.

A list is a log of dated entries: at a time, a pattern is added to or taken off a list. Per pattern
the log becomes validity intervals, each entry's interval ending where the next one begins. A
capture asks for every pattern that could cover it: its host, each parent domain, and each folder of
its path under each of these. An equi-join on the pattern brings the pattern's intervals as one
sorted array, and the as-of step keeps those that hold at the fetch time. There are only built-in expressions; the join has one list row for each pattern, so a host with a third of
all captures multiplies no rows, and its captures can be split between tasks.

Patterns are stored as host, or host and path prefix that ends at a folder: ``example.com``,
``example.com/ads``. Both sides are normalised alike: lower-case host without ``www.``, port, user
and final dot; path in its own case, without query, fragment and final slash.

Edge cases: a null or hostless URL, or a null fetch time, matches nothing and is kept; entries
without a pattern or date are ignored; repeated entries change nothing; of several entries of one
pattern and list at the same time a removal wins over an addition; repeated captures give repeated
rows; an empty list keeps everything; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.keyed import combined

ADD, REMOVE = "add", "remove"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port, ``www.`` and final dot; empty if there is none."""
    host = F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(F.regexp_replace(host, "^www\\.", ""), "\\.$", "")


def path_of(url: Column) -> Column:
    """Path without query, fragment and slashes at its ends."""
    path = F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.regexp_replace(path, "^/+|/+$", "")


def candidates(host: Column, path: Column) -> Column:
    """Every pattern that covers a page: host and parent domains, each alone and with each folder."""
    labels = F.split(host, "\\.")
    # A lone top-level label is never a pattern.
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    folders = F.split(path, "/+")
    prefixes = F.concat(
        F.array(F.lit("")),
        F.when(path == "", F.array().cast("array<string>")).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.size(folders)),
                lambda n: F.concat(F.lit("/"), F.array_join(F.slice(folders, 1, n), "/")),
            )
        ),
    )
    paired = F.flatten(F.transform(domains, lambda d: F.transform(prefixes, lambda p: F.concat(d, p))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(paired))


def intervals(entries: DataFrame) -> DataFrame:
    """One row for each pattern: ``states``, sorted by time, of ``(at, list, active, until)``.

    ``entries`` has ``pattern, list, action, at``. A pattern's log is bounded by how often list
    keepers touch one pattern, not by the captures.
    """
    page = F.concat(F.lit("http://"), F.trim("pattern"))  # a pattern is a URL without its scheme
    path = F.regexp_replace(path_of(page), "/+", "/")
    normal = F.when(host_of(page) != "", F.concat_ws("/", host_of(page), F.when(path != "", path)))
    log = (
        entries.select(normal.alias("pattern"), F.col("list"), (F.col("action") == ADD).alias("active"), "at")
        .where("pattern <> '' AND at IS NOT NULL AND active IS NOT NULL AND list IS NOT NULL")
        .groupBy("pattern", "list", "at")
        .agg(F.min("active").alias("active"))
    )
    dated = log.groupBy("pattern", "list").agg(F.sort_array(F.collect_list(F.struct("at", "active"))).alias("log"))
    valid = F.transform(
        "log",
        lambda e, i: F.struct(
            e["at"].alias("since"), F.try_element_at("log", i + 2)["at"].alias("until"), e["active"].alias("active")
        ),
    )
    active = F.filter(valid, lambda v: v["active"])
    named = dated.select(
        "pattern",
        F.explode(active).alias("v"),
        "list",
    ).select("pattern", F.struct("v.since", "v.until", "list").alias("v"))
    # Exchanged anew for the join with the captures, so that a host with most of them can be split.
    return combined(named, "pattern", F.sort_array(F.collect_list("v")).alias("states"))


def filter_captures(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
    time_col: str = "fetched_at",
) -> DataFrame:
    """One row per capture: host, lists and patterns in force at its fetch time, and the verdict.

    ``captures`` has an id, a URL and a fetch time; ``entries`` as for ``intervals``.
    """
    host, path = host_of(F.col("_url")), path_of(F.col("_url"))
    rows = captures.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(url_col), F.lit("")).alias("_url"),
        F.col(url_col).alias("url"), F.col(time_col).alias("fetched_at"),
    ).withColumn("host", host)
    # Captures of one URL at one time share their answer, so each is looked up once. Those without a URL ask nothing.
    asking = rows.where("_url <> ''")
    asked = asking.groupBy("_url", "host", "fetched_at").agg(F.count("*").alias("_n"))
    probes = asked.select(
        "_url", "fetched_at", F.explode(candidates(F.col("host"), path)).alias("probe")
    ).where("fetched_at IS NOT NULL")
    listed = intervals(entries)
    in_force = lambda s: (s["since"] <= F.col("fetched_at")) & (
        s["until"].isNull() | (s["until"] > F.col("fetched_at"))
    )
    hits = probes.join(listed, F.col("probe") == F.col("pattern")).select(
        "_url", "fetched_at", F.col("probe"), F.filter("states", in_force).alias("now")
    ).where(F.size("now") > 0)
    answers = combined(
        hits, ["_url", "fetched_at"],
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("now.list")))).alias("lists"),
        F.array_sort(F.collect_set("probe")).alias("patterns"),
    ).select(F.col("_url").alias("u"), F.col("fetched_at").alias("t"), "lists", "patterns")
    none = F.array().cast("array<string>")
    out = asking.join(answers, (F.col("_url") == F.col("u")) & (F.col("fetched_at") == F.col("t")), "left").drop("u", "t")
    out = out.unionByName(rows.where("_url = ''").withColumns(dict.fromkeys(("lists", "patterns"), F.lit(None).cast("array<string>"))))
    return out.select(
        F.col("_id").alias(id_col), "url", "fetched_at", "host",
        F.array_join(F.coalesce("lists", none), ",").alias("lists"),
        F.array_join(F.coalesce("patterns", none), ",").alias("patterns"),
        F.col("lists").isNull().alias("kept"),
    )


# --- the query's captures and list --------------------------------------------------------------

# The pages carry no fetch time and there is no list table, so both follow from the pages: page N is
# fetched N hours (mod 400 days) into the year, and hosts, parent domains and language folders get
# list entries by a digest of their names.
START = "2024-01-01 00:00:00"
SPAN_HOURS = 9_600


def page_captures(pages: DataFrame) -> DataFrame:
    hours = F.coalesce(F.col("page_id"), F.lit(0)) % SPAN_HOURS
    at = F.timestamp_add("HOUR", hours.cast("int"), F.lit(START).cast("timestamp_ntz"))
    return pages.select("page_id", "url", at.alias("fetched_at"))


def _mark(text: Column) -> Column:
    """A number that follows from the text, the same in other engines."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 7), 16, 10).cast("long")


def page_list(pages: DataFrame) -> DataFrame:
    """Dated entries: a sixth of the hosts listed, half of those taken off again; one domain in nine;
    the language folder of one host in five."""
    hosts = pages.select(host_of(F.coalesce("url", F.lit(""))).alias("host"), path_of(F.coalesce("url", F.lit(""))).alias("path"))
    hosts = hosts.where("host <> ''").withColumn("folder", F.split("path", "/+")[0])
    hosts = hosts.groupBy("host").agg(F.min("folder").alias("folder"))
    domain = F.regexp_extract("host", "([^.]+\\.[^.]+\\.[^.]+)$", 1)
    mark, mark_domain = _mark(F.col("host")), _mark(F.col("pattern"))
    at = lambda days: F.timestamp_add("DAY", days.cast("int"), F.lit(START).cast("timestamp_ntz"))
    blocked = hosts.where(mark % 6 == 0)
    parts = [
        blocked.select(F.col("host").alias("pattern"), F.lit("spam").alias("list"), F.lit(ADD).alias("action"), at(mark % 300).alias("at")),
        blocked.where(mark % 12 == 0).select(
            F.col("host").alias("pattern"), F.lit("spam").alias("list"), F.lit(REMOVE).alias("action"), at(mark % 300 + 40).alias("at")),
        hosts.select(domain.alias("pattern")).where("pattern <> ''").distinct().where(mark_domain % 9 == 0).select(
            "pattern", F.lit("adult").alias("list"), F.lit(ADD).alias("action"), at(mark_domain % 200).alias("at")),
        hosts.where((mark % 5 == 0) & (F.col("folder") != "")).select(
            F.concat("host", F.lit("/"), "folder").alias("pattern"), F.lit("folder").alias("list"),
            F.lit(ADD).alias("action"), at(mark % 350).alias("at")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


ORACLE_SQL = """
WITH raw AS (
  SELECT page_id, url, coalesce(url, '') AS u,
         TIMESTAMP '2024-01-01' + to_hours(CAST(coalesce(page_id, 0) % 9600 AS INTEGER)) AS fetched_at FROM pages),
cap AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/?#:]*)', 2)),
           '^www[.]', ''), '[.]$', '') AS host,
         trim(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') AS path FROM raw),
hosts AS (
  SELECT host, min(regexp_split_to_array(path, '/+')[1]) AS folder,
         CAST('0x' || substring(md5(host), 1, 7) AS BIGINT) AS mark FROM cap WHERE host <> '' GROUP BY host),
domains AS (SELECT DISTINCT regexp_extract(host, '([^.]+[.][^.]+[.][^.]+)$', 1) AS pattern FROM hosts),
marked AS (SELECT pattern, CAST('0x' || substring(md5(pattern), 1, 7) AS BIGINT) AS mark FROM domains WHERE pattern <> ''),
held AS (
  SELECT host AS pattern, 'spam' AS list, mark % 300 AS since,
         CASE WHEN mark % 12 = 0 THEN mark % 300 + 40 END AS until FROM hosts WHERE mark % 6 = 0
  UNION ALL SELECT pattern, 'adult', mark % 200, NULL FROM marked WHERE mark % 9 = 0
  UNION ALL SELECT host || '/' || folder, 'folder', mark % 350, NULL FROM hosts WHERE mark % 5 = 0 AND folder <> ''),
dated AS (
  SELECT pattern, list, split_part(pattern, '/', 1) AS d, substring(pattern, strpos(pattern || '/', '/') + 1) AS f,
         TIMESTAMP '2024-01-01' + to_days(CAST(since AS INTEGER)) AS since,
         TIMESTAMP '2024-01-01' + to_days(CAST(until AS INTEGER)) AS until FROM held),
hit AS (
  SELECT page_id, array_to_string(list_sort(list(DISTINCT list)), ',') AS lists,
         array_to_string(list_sort(list(DISTINCT pattern)), ',') AS patterns
  FROM cap JOIN dated ON (host = d OR ends_with(host, '.' || d))
    AND (f = '' OR path = f OR starts_with(path, f || '/'))
    AND fetched_at >= since AND (until IS NULL OR fetched_at < until)
  GROUP BY page_id)
SELECT page_id, url, fetched_at, host, coalesce(lists, '') AS lists, coalesce(patterns, '') AS patterns,
       lists IS NULL AS kept
FROM cap LEFT JOIN hit USING (page_id)
"""
