"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import jaccard_join, language_crf, packing, repetition, suffix_dedup
from quarry.llm.common import forget, table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, texts in none of the learned languages
    (judged by n-grams) and texts spread over many of them (less than a third of
    the letters in the best one)."""
    return language_crf.keep_identified(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are too short or repeat themselves."""
    return repetition.keep_good(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return jaccard_join.drop_near_duplicates(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts 50-byte strings that also start in a document with a smaller id."""
    return suffix_dedup.without_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("best_fit_packing", best_fit_packing),
]

# Fitted models, suffix order and packing have no SQL form; tests/llm holds each
# stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, done = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        forget(*done)       # what this stage has read
        done = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
