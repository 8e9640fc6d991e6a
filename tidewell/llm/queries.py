"""One query for each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import (
    chat_format, decontaminate, language_id, lexical_search, license_scan, near_dedup, quality_rules, sentencepiece_nbest,
    sharding, suffix_dedup, token_counts, url_filter, whitening,
)
from tidewell.llm.common import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op5_quality_rules(spark, sf):
    return quality_rules.quality_report(load(spark, sf, "documents"))


SQL["op5_quality_rules"] = quality_rules.oracle().strip()


@query
def op10_histogram_shards(spark, sf):
    return sharding.shard_rows(load(spark, sf, "documents"), shards=16)


@query
def op1_sentencepiece(spark, sf):
    return sentencepiece_nbest.encode_texts(load(spark, sf, "documents"), n=4)


@query
def op8_setsketch_dedup(spark, sf):
    return near_dedup.near_duplicates(load(spark, sf, "documents"), width=2)


@query
def op9_token_counts(spark, sf):
    counted = token_counts.token_budget(load(spark, sf, "documents"), budget=4096)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars")


@query
def op2_suffix_dedup(spark, sf):
    return suffix_dedup.digest(suffix_dedup.remove_repeats(load(spark, sf, "documents")))


@query
def op3_url_filter(spark, sf):
    pages = load(spark, sf, "pages")
    return url_filter.filter_captures(url_filter.page_captures(pages), url_filter.page_list(pages))


SQL["op3_url_filter"] = url_filter.ORACLE_SQL.strip()


@query
def op4_template_decontamination(spark, sf):
    return decontaminate.contaminated(load(spark, sf, "documents"), load(spark, sf, "benchmark"))


@query
def op6_language_id(spark, sf):
    documents = load(spark, sf, "documents")
    held = language_id.held_out()
    filters = language_id.learn(documents.where(~held))
    found = language_id.identify(documents, filters)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op7_chat_format(spark, sf):
    return chat_format.format_chats(load(spark, sf, "conversations"))


@query
def op13_license_scan(spark, sf):
    return license_scan.license_report(load(spark, sf, "documents"))


@query
def op11_embedding_whitening(spark, sf):
    return whitening.whitened_components(load(spark, sf, "embeddings"))


@query
def op12_lexical_search(spark, sf):
    return lexical_search.search(load(spark, sf, "documents"), load(spark, sf, "benchmark"), k=50)


SQL["op12_lexical_search"] = lexical_search.ORACLE_SQL.strip()
