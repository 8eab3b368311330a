"""Training documents from raw ones: language, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir); its rows are written as Parquet and read again by the next one.
All but the last return the columns of `documents`; the last returns the packed pieces of `op3_packing`.
SQL can express neither the trained language model nor the encoder, so there is no SQL for the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from beaconry.llm import decontamination, language, packing, simhash_dedup, suffix_dedup
from beaconry.llm.common import stored
from beaconry.session import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a letter."""
    return language.understood(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id."""
    return simhash_dedup.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without the passages (over 50 words, or 400 bytes) that stand elsewhere too."""
    return suffix_dedup.without_repeats(docs, kinds=(suffix_dedup.BYTES, suffix_dedup.PASSAGES))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark question."""
    return decontamination.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [("language ID", language_id), ("SimHash near-dedup", near_duplicates), ("suffix-array dedup", repeated_passages),
          ("benchmark decontamination", benchmark_leaks), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
