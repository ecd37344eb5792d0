"""The corpus pipeline: documents in, encoded training documents out.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. Its result is written as Parquet to the shared folder and read
again as the next stage's documents, so a lost executor costs one stage at most. All stages but the last return the columns
of the documents they were given, whatever these are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import byte_bpe, byte_cnn, minhash_dedup, quality_rules, raking
from millrace.registry import Tables
from millrace.session import checkpointed


#: Rows that a Python worker gets at once. Its memory, and the buffers of the executor that feeds it, follow their texts.
BATCH_ROWS = 1000


def _in_small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    _in_small_batches(spark)
    return quality_rules.keep_good(docs)


def apply_quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, fitted on the labelled ones among them, scores high enough."""
    _in_small_batches(spark)
    return byte_cnn.keep_scored(docs, Tables(spark, sf_dir).labels)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    _in_small_batches(spark)
    return minhash_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the target weights of source, language and topic, each once at most.

    Classes above their natural share by more than 1 / KEEP stay short of their targets: copies would meet these, but the
    stages after the near-duplicates pass on every document once.
    """
    return raking.sample(docs, once=True)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, the number of these, and digests of the ids and of what they decode to."""
    _in_small_batches(spark)
    # few words are kept, as the workers have served the other stages before and serve more than this one
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digests=True, kept_words=40_000)


STAGES = [
    ("quality rules", apply_quality_rules),
    ("quality classifier", apply_quality_classifier),
    ("minhash near-dedup", drop_near_duplicates),
    ("mixing to target weights", mix_sources),
    ("byte-level bpe", encode_tokens),
]

#: No SQL: the classifier is learned, the weights are fitted by iteration, and the tokenizer splits by Unicode classes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of a folder."""
    docs = Tables(spark, sf_dir).documents
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
