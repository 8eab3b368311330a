"""The dealt operators on the benchmark tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beaconry.session import read_table

from . import (byte_bpe, decontamination, fill_in_middle, html_text, language, outliers, packing, prefix_trie, simhash_dedup,
               suffix_dedup, tokens, tool_calls, url_filter)


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.length_table(tokens.token_counts(read_table(spark, sf_dir, "documents")))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read_table(spark, sf_dir, "documents"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("k1", "k2")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(read_table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = tool_calls.link(*tool_calls.turns_as_calls(read_table(spark, sf_dir, "conversations")))
    return linked.withColumnsRenamed({"conv": "conv_id", "call": "call_id"})


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judged(read_table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(read_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_url_filters, op2_token_counts, op3_packing, op4_language_id, op5_simhash_near_dedup, op6_benchmark_decontamination,
    op7_html_extraction, op8_suffix_array_dedup, op9_chat_formatting, op10_quality_rules,
    op11_byte_bpe, op12_fill_in_middle, op13_prefix_trie)}
_URLS = url_filter.judge_sql()
ORACLES: dict[str, str] = {
    "op1_url_filters": f"SELECT page_id, host, path, rule, verdict FROM ({_URLS})",
    "op6_benchmark_decontamination": decontamination.leaks_sql(),
    "op9_chat_formatting": tool_calls.conversations_sql(),
    "op12_fill_in_middle": fill_in_middle.digests_sql(),
    "op13_prefix_trie": prefix_trie.trie_sql(),
}
