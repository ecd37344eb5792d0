"""The named queries of this folder: name -> (spark, folder) -> DataFrame, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    ball_tree, byte_bpe, byte_cnn, conversation_repair, language_mixture, license_rules, minhash_dedup, packing, quality_rules, raking, source_audit, sql_twins,
    url_rules, warc_derivatives,
)
from millrace.registry import Tables


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_duplicates(Tables(spark, folder).documents)


def op2_license_sentence_rules(spark: SparkSession, folder: str) -> DataFrame:
    return license_rules.licence_digest(Tables(spark, folder).documents)


def op3_ball_tree_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return ball_tree.embedding_neighbours(Tables(spark, folder).embeddings)


def op4_url_pattern_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.url_verdicts(Tables(spark, folder).pages)


def op5_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return warc_derivatives.page_derivatives(Tables(spark, folder).pages)


def op6_byte_cnn_quality(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return byte_cnn.quality_scores(t.documents, t.labels)


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.token_digests(Tables(spark, folder).documents, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return language_mixture.language_digest(Tables(spark, folder).documents)


def op9_raked_mix(spark: SparkSession, folder: str) -> DataFrame:
    return raking.mix_digest(Tables(spark, folder).documents)


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.rules_digest(Tables(spark, folder).documents)


def op11_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.audit(Tables(spark, folder).documents)


def op12_sum_of_squares_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packing_digest(Tables(spark, folder).documents, public_tokenizers.path("byte_bpe_50k.json"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.repair_digest(Tables(spark, folder).conversations)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup, op2_license_sentence_rules, op3_ball_tree_top_k, op4_url_pattern_rules, op5_warc_derivatives,
        op6_byte_cnn_quality, op7_byte_bpe, op8_language_mixture, op9_raked_mix, op10_quality_rules, op11_source_audit,
        op12_sum_of_squares_packing, op13_conversation_repair,
    )
}
SQL: dict[str, str] = sql_twins.SQL
