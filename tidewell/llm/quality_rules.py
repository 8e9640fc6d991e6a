"""Quality rules: a threshold table compiled into one projection of built-in expressions.

Counts are exact over whole texts and every rule is a ratio in whole per cent, compared with
integers, so a verdict never depends on rounding. There is no user function, join or shuffle.

Edge cases: a null text has no words and fails; an empty table gives an empty result; equal rows
are judged alike; ids may be null; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import with_text

WORD_GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent function words of the languages that are expected.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he his this are or from at "
    "der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es werden aus hat dass "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se "
    "el y los del las con una su para al lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """``least <= 100 * part / whole <= most``; a bound of None is not checked."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None

    def holds(self) -> Column:
        part, whole = 100 * F.col(self.part), F.col(self.whole)
        checks = []
        if self.least is not None:
            checks.append(part >= self.least * whole)
        if self.most is not None:
            checks.append(part <= self.most * whole)
        return F.lit(True) if not checks else checks[0] if len(checks) == 1 else checks[0] & checks[1]


# The base check every text must pass, and the thresholds of the method.
BASE_MIN_WORDS = 10
BASE_RULES = (Rule("repeated_windows", "n_repeat_words", "n_words", most=20),)
RULES = (
    Rule("word_length", "word_chars", "n_words", least=200, most=1500),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("stop_words", "n_stop_words", "n_words", least=6),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=30),
)


def _counted(df: DataFrame) -> DataFrame:
    """Words, lines and symbols of each text as columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    stops = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]
    has_word = lambda line: line.rlike("[^\\x20\\x09-\\x0D]")
    listed = df.select(
        "doc_id",
        text.alias("_text"),
        F.filter(F.split(text, WORD_GAP), lambda w: w != "").alias("_words"),
        F.filter(F.split(text, "\n"), has_word).alias("_lines"),
    )
    return listed.select(
        "doc_id",
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_words", lambda w: F.rtrim(w, F.lit(".,;:")).isin(stops)))
        .cast("long")
        .alias("n_stop_words"),
    )


def _repeated(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside a window of five that the text has twice or more.

    Windows are compared by a 64-bit hash; only texts in which one repeats are sorted.
    """
    words = F.col("_words")
    window = lambda i: F.struct(
        F.xxhash64(*(words[i + k] for k in range(WINDOW))).alias("h"), i.alias("i")
    )
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW))
    hashed = df.withColumn("_w", F.coalesce(F.transform(starts, window), F.array().cast("array<struct<h:bigint,i:int>>")))
    sort = F.size(F.array_distinct("_w.h")) < F.size("_w")
    ordered = hashed.withColumn("_s", F.when(sort, F.sort_array("_w")))
    def same(x, i):
        after = F.try_element_at("_s", i + 2)["h"] == x["h"]
        return F.when(i > 0, F.try_element_at("_s", i)["h"] == x["h"]).otherwise(False) | F.coalesce(after, F.lit(False))

    shared = ordered.withColumn("_p", F.sort_array(F.transform(F.filter("_s", same), lambda x: x["i"])))
    step = lambda acc, p: F.struct(
        (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")
    )
    covered = F.aggregate("_p", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")), step, lambda a: a["n"])
    return shared.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))


def quality_report(
    df: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per text: the counts, the first rule it breaks, and the verdict."""
    counted = _repeated(_counted(with_text(df, id_col, text_col)))
    base = F.col("n_words") < BASE_MIN_WORDS
    for rule in BASE_RULES:
        base = base | ~rule.holds()
    broken = F.coalesce(
        *(F.when(~r.holds(), F.lit(r.name)) for r in rules), F.lit(None).cast("string")
    )
    judged = counted.withColumn("base_failed", base).withColumn("broken_rule", broken)
    return judged.select(
        F.col("doc_id").alias(id_col),
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words",
        "base_failed", "broken_rule",
        (~F.col("base_failed") & F.col("broken_rule").isNull()).alias("kept"),
    )


def keep_good(df: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows that pass, with all their columns: the whole row takes the place of the id."""
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.col(text_col).alias("text"))
    report = quality_report(rows, rules, id_col="row")
    # A filter on the verdict would be moved below the projections and repeat their work inside it;
    # an outer explode of no row or one row is not.
    passed = report.select(F.explode_outer(F.expr("IF(kept, array(row), NULL)")).alias("row"))
    return passed.where("row IS NOT NULL").select("row.*")


def oracle() -> str:
    """The same report in DuckDB SQL, from the same threshold table."""
    stops = ",".join(f"'{w}'" for w in [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)])

    def holds(rule: Rule) -> str:
        parts = []
        if rule.least is not None:
            parts.append(f"100 * {rule.part} >= {rule.least} * {rule.whole}")
        if rule.most is not None:
            parts.append(f"100 * {rule.part} <= {rule.most} * {rule.whole}")
        return "(" + " AND ".join(parts) + ")"

    base = " OR ".join([f"n_words < {BASE_MIN_WORDS}", *(f"NOT {holds(r)}" for r in BASE_RULES)])
    first = " ".join(f"WHEN NOT {holds(r)} THEN '{r.name}'" for r in RULES)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, t,
        list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, w[i:i+4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM l)),
dup AS (SELECT doc_id, unnest(list_distinct(flatten(list([i, i+1, i+2, i+3, i+4])))) AS p
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1 GROUP BY doc_id),
rep AS (SELECT doc_id, count(*) AS n_repeat_words FROM dup GROUP BY doc_id),
c AS (SELECT doc_id, len(w)::BIGINT AS n_words,
        length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        len(list_filter(w, lambda x: rtrim(x, '.,;:') IN ({stops})))::BIGINT AS n_stop_words
      FROM l LEFT JOIN rep USING (doc_id)),
j AS (SELECT *, {base} AS base_failed, CASE {first} END AS broken_rule FROM c)
SELECT *, NOT base_failed AND broken_rule IS NULL AS kept FROM j
"""
