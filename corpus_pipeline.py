"""A training-data pipeline over `documents`: toxicity, language, near copies, benchmark passages, token ids.

Each stage works on all that the one before it kept, and is written before the next one reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clipcurate.llm import bpe, decontaminate, langid, near_dedup, toxicity
from clipcurate.llm.common import table
from clipcurate.session import ship_code, written

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Rows that are read from a file, or go to a Python worker, at once. All columns go along, so that more rows only cost
#: memory: a batch of texts is one block of the heap, several times as large while it grows.
ARROW_ROWS = 1_000
READ_ROWS = 500


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the multiple-instance model, learnt from `labels`, does not predict toxic."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is told with the calibrated certainty."""
    return langid.keep_identified(docs, langid.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies."""
    return near_dedup.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of `benchmark`; what consists of them for the most part goes."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, decoded once for a check."""
    return bpe.encode(docs, bpe.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN)



def _in_small_batches(stage):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
        spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", READ_ROWS)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    (name, _in_small_batches(stage))
    for name, stage in (
        ("toxicity", drop_toxic),
        ("language", keep_known_languages),
        ("near_dedup", drop_near_copies),
        ("decontamination", drop_benchmark),
        ("byte_bpe", encode_tokens),
    )
]

#: The stages learn models and follow links to any depth, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
