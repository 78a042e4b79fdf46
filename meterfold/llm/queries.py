"""One query for each operator, with production settings, on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterfold.llm import decontaminate, html_template, line_dedup, merkle, ngram_lm, packing, quality, ranked_search, recompression, rules, simhash, suffix_array, url_lists

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op6_simhash_near_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"), radius=2, width=3)


@_query("op3_benchmark_decontamination")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )


def tokenizer_file() -> str:
    """The vocabulary file of the tokenizers package that every machine has."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_query("op4_best_fit_packing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), tokenizer_file(), capacity=2048)


@_query("op9_temporal_url_lists", url_lists.SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    found = url_lists.as_of(url_lists.fetch_days(pages), url_lists.derived_events(pages))
    return found.withColumn("fetched", F.col("fetched").cast("string"))


@_query("op10_quality_rule_cascade", rules.SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judged(_table(spark, folder, "documents"))


@_query("op2_suffix_array_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_array.without_repeats(_table(spark, folder, "documents"), with_text=False).drop("kept")


@_query("op7_recompression_substring_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return recompression.without_repeats(_table(spark, folder, "documents"), with_text=False).drop("kept")


@_query("op1_quality_classifier")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.classified(
        _table(spark, folder, "documents"), _table(spark, folder, "labels"), host="source", path="lang"
    )
    return found.select(
        "doc_id", "host", "path", "p_low", "p_toxic", "p_document", "host_rate", "path_rate", "p_bad", "kept"
    )


@_query("op8_deleted_interpolation_lm")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_lm.scores(_table(spark, folder, "documents"))


@_query("op5_html_template_removal")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return html_template.main_text(_table(spark, folder, "pages"))


@_query("op11_line_dedup", line_dedup.SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.without_common_lines(_table(spark, folder, "documents"), with_text=False).drop("kept")


@_query("op13_merkle_manifest", merkle.SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified(_table(spark, folder, "documents"), merkle.every_fifth())


@_query("op12_ranked_lexical_search", ranked_search.SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), k=20)
