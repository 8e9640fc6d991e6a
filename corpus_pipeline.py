"""The corpus pipeline: five stages, each one operator, each over all its predecessor kept.

Every stage takes the documents as its predecessor wrote them and returns documents again; the last
one returns encoded texts. ``run`` writes each stage's rows as Parquet to the shared folder and
reads them back, so an executor lost later repeats no finished stage.

Edge cases follow the operators: null and empty texts fall to the quality rules; the stages that drop
rows judge each by itself, whether its id is null or repeated, and of equal rows the second lets one go on; empty tables give empty results; columns beyond those of ``documents`` are handed on by the stages that
drop rows and left out from the third stage on.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontaminate, near_dedup, quality_rules, sentencepiece_nbest, suffix_dedup
from tidewell.llm.common import load, row_key, stage, without_ids
from tidewell.session import delete_path, staged_copies

WIDTH, PERCENT = 5, 80  # words to a shingle, similarity of near duplicates


_LEFT: list[str] = []  # working copies of the stage that was called last


def clearing(function):
    """A stage that first removes the working copies of the stage before it, whose result has been written by then."""

    @wraps(function)
    def called(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _LEFT:
            delete_path(spark, _LEFT.pop())
        before = len(staged_copies())
        result = function(spark, docs, sf_dir)
        _LEFT.extend(staged_copies(before))
        return result

    return called


@clearing
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


@clearing
def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the least id; null ids come last.

    Rows are numbered, so that those without an id and those that repeat one are told apart. The numbers
    are written down, as they depend on how the rows are dealt.
    """
    rows = stage(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = near_dedup.near_duplicates(rows, WIDTH, PERCENT, id_col="_row").select("_row", "component_id")
    placed = stage(found.join(rows.select("_row", "doc_id"), "_row"), "placed")
    least = placed.groupBy("component_id").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "_row")).alias("least"))
    gone = placed.join(least.select("least._row"), "_row", "left_anti")
    return without_ids(rows, gone, "_row").drop("_row")


@clearing
def unrepeated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that repeat; those left without a word go."""
    cut = suffix_dedup.remove_repeats(docs, carry=("lang", "source"), as_text=True)
    left = cut.select(
        "doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars")
    )
    return left.where(F.col("text").rlike("[^\\x20\\x09-\\x0D]"))


@clearing
def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    rows = docs.withColumn("_row", row_key())
    found = decontaminate.contaminated(rows, load(spark, sf_dir, "benchmark"), id_col="_row")
    return without_ids(rows, found, "_row").drop("_row")


@clearing
def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document's best segmentation, and the scores of its two best."""
    return sentencepiece_nbest.encode_texts(docs, n=2)


STAGES = [
    ("quality_rules", good_documents),
    ("minhash_near_dedup", distinct_documents),
    ("suffix_array_dedup", unrepeated_documents),
    ("benchmark_decontamination", clean_documents),
    ("sentencepiece_encoding", encoded_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Stages 2 to 5 have no form in SQL; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None
