"""Manifests of kept clips and their split into fixed-size shards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcurate.config import SHARD_ROWS
from clipcurate.functions.names import default_speaker, wav_path
from clipcurate.operators.ordering import number_rows
from clipcurate.operators.verdict import KEPT

PACK_ORDER = ("language", "id")


def manifest(verdicts: DataFrame) -> DataFrame:
    """Kept clips with the columns every writer needs; source speaker ids are replaced."""
    return verdicts.where(F.col("verdict") == KEPT).select(
        "id",
        "language",
        wav_path(F.col("id")).alias("wav_path"),
        F.col("clean_text").alias("text"),
        default_speaker(F.col("language")).alias("speaker"),
        "duration",
        "duration_ms",
        "cps",
        "src_file",
        "src_row",
    )


def all_manifests(*parts: DataFrame) -> DataFrame:
    """Manifests of several runs; one that has no rate column gets nulls."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def with_defaults(rows: DataFrame) -> DataFrame:
    """A missing speaker becomes the language's default, a missing rate becomes 0."""
    return rows.withColumn(
        "speaker", F.coalesce(F.col("speaker"), default_speaker(F.col("language")))
    ).withColumn("cps", F.coalesce(F.col("cps"), F.lit(0.0)))


def with_wav_present(rows: DataFrame, listing: DataFrame) -> DataFrame:
    return rows.join(listing.select("wav_path"), "wav_path", "left_semi")


def missing_wavs(rows: DataFrame, listing: DataFrame) -> DataFrame:
    missing = rows.join(listing.select("wav_path"), "wav_path", "left_anti")
    return missing.groupBy("language").agg(F.count(F.lit(1)).alias("missing"))


def assign_shards(rows: DataFrame, shard_rows: int = SHARD_ROWS, after: int = 0) -> DataFrame:
    """Row and shard number of every clip in pack order. Pass narrow columns, without audio.

    Numbers run on from one language to the next, so a shard may hold the end of one and the start of
    another, and every shard but the last has exactly `shard_rows` rows. `after` rows are packed already.
    """
    shard = F.call_function("div", F.col("row_no") - 1, F.lit(shard_rows).cast("long"))
    numbered = number_rows(rows, *PACK_ORDER)
    if after:
        numbered = numbered.withColumn("row_no", F.col("row_no") + F.lit(after).cast("long"))
    return numbered.withColumn("shard_id", shard)
