"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from quarry.llm import (chat, collocations, differencing, grid_order_join, jaccard_join, language_crf, licenses, packing,
                        pieces, repetition, sharding, suffix_dedup, whitening)
from quarry.llm.common import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicate_report(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_crf.identify(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.rendezvous_shards(table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_order_join.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_report(table(spark, sf_dir, "documents"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = chat.message_events(chat.with_probe(table(spark, sf_dir, "conversations")), revise=True)
    return chat.read_back(chat.format_chats(log))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_rules(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(table(spark, sf_dir, "documents"))


def op11_karmarkar_karp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return differencing.window_report(table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_collocations(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_ngram_jaccard_join, op2_language_id, op3_sharding, op4_embedding_near_dedup,
        op5_best_fit_packing, op6_sentencepiece,
        op7_chat_formatting, op8_license_scan, op9_quality_rules, op10_suffix_dedup,
        op11_karmarkar_karp_packing, op12_phrase_collocations, op13_embedding_whitening, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op7_chat_formatting": chat.ORACLE_SQL, "op8_license_scan": licenses.oracle_sql(),
            "op12_phrase_collocations": collocations.ORACLE_SQL}
