"""Registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipcurate.llm import (
    bitplane,
    bpe,
    decontaminate,
    divergence,
    langid,
    near_dedup,
    packing,
    page_diff,
    quality,
    simhash,
    toxicity,
    training_order,
    url_templates,
)
from clipcurate.llm.common import held_out, table
from clipcurate.llm.oracles import CLUSTER_SQL, DIVERGENCE_SQL, HTML_SQL, MATCH_SQL, URL_SQL

RANKS = "byte_bpe_multi_50k.tiktoken"
WORDS = "word_bpe_49k.json"


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near copies, the copies of its text, and whether it stays."""
    return near_dedup.classes(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("_x")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = langid.identify(documents.select("doc_id", "text"), langid.fit(documents))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_diff.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every token sequence of the documents stands in the training order, read back from the shards."""
    place = ("file", "row")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    shards = training_order.materialise(documents, ranks, public_tokenizers.PATTERN, place=place)
    return training_order.positions(shards)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_templates.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "template")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    found = bpe.encode(documents, ranks, public_tokenizers.PATTERN, ids=None)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxic_score").alias("score"),
        F.col("toxic_pred").alias("predicted"), F.size("offending").cast("long").alias("n_offending"),
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.match(documents, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.compare_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.score(documents, quality.fit(documents, table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"),
        F.col("quality_pred").alias("predicted"),
    )


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each source diverges from the others of its language, and in which terms."""
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplane.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token piece of the documents with its place in a packed sequence."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.pack(documents, public_tokenizers.path(WORDS), keep_ids=False)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dedup,
        op2_language,
        op3_html_text,
        op4_training_order,
        op5_url_filter,
        op6_byte_bpe,
        op7_toxicity,
        op8_decontaminate,
        op9_simhash,
        op10_quality,
        op11_divergence,
        op12_clusters,
        op13_packing,
    )
}

ORACLE = {
    "op3_html_text": HTML_SQL,
    "op5_url_filter": URL_SQL,
    "op8_decontaminate": MATCH_SQL,
    "op11_divergence": DIVERGENCE_SQL,
    "op12_clusters": CLUSTER_SQL,
}
