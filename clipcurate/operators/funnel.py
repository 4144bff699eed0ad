"""Counts that say where clips went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcurate.config import BATCH_SIZE, EPOCHS, GRADIENT_ACCUMULATION
from clipcurate.operators import verdict as v

_MS_PER_HOUR = 3_600_000.0


def _rejections() -> list[Column]:
    return [
        F.count_if(F.col("verdict") == name).alias(name)
        for name in (
            v.TEXT_REJECTED,
            v.DECODE_ERROR,
            v.DURATION_REJECTED,
            v.CPS_REJECTED,
            v.MULTI_SPEAKER_REJECTED,
            v.KEPT,
        )
    ]


def funnel_by_language(verdicts: DataFrame) -> DataFrame:
    """One row per language. The counts after `lang_filtered` add up to it."""
    return verdicts.groupBy("language").agg(
        F.sum("copies").alias("lang_filtered"),
        F.sum(F.col("copies") - 1).alias("duplicates"),
        *_rejections(),
    )


def funnel(clips: DataFrame, verdicts: DataFrame) -> DataFrame:
    """One row for a run. `total` counts every scanned clip, of any language."""
    totals = clips.agg(F.count(F.lit(1)).alias("total"))
    counts = verdicts.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("lang_filtered"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
        *_rejections(),
    )
    return counts.select(totals.scalar().alias("total"), *counts.columns)


def funnel_of_counts(counts: DataFrame) -> DataFrame:
    """The same row per language from partial counts `(language, verdict, clips)` of any number of runs."""
    clips = F.col("clips")

    def of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("verdict") == name, clips)), F.lit(0))

    return counts.groupBy("language").agg(
        F.sum("clips").alias("lang_filtered"),
        of(v.DUPLICATE).alias("duplicates"),
        *[of(name).alias(name) for name in v.VERDICTS],
    )


def total_funnel(clips: DataFrame, by_language: DataFrame) -> DataFrame:
    """One row for a run from a row per language. `total` counts every scanned clip, of any language."""
    total = clips.agg(F.count(F.lit(1)).alias("total"))
    names = [c for c in by_language.columns if c != "language"]
    counts = by_language.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    return counts.select(total.scalar().alias("total"), *names)


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("language", "verdict").agg(
        F.count(F.lit(1)).alias("clips"), F.sum("duration_ms").alias("duration_ms")
    )


def with_rejection_rate(counts: DataFrame) -> DataFrame:
    rate = 1 - F.col("kept").cast("double") / F.col("lang_filtered").cast("double")
    return counts.withColumn("rejection_rate", F.when(F.col("lang_filtered") > 0, rate))


def clean_counts(kept: DataFrame) -> DataFrame:
    """Rows per language and, with a null language, in total."""
    return kept.rollup("language").agg(F.count(F.lit(1)).alias("clips"))


def corpus_profile(
    clips: DataFrame,
    batch_size: int = BATCH_SIZE,
    grad_accum: int = GRADIENT_ACCUMULATION,
    epochs: int = EPOCHS,
) -> DataFrame:
    """Clips, hours and an estimate of optimizer steps, per language."""
    effective = batch_size * grad_accum
    return (
        clips.groupBy("language")
        .agg(
            F.count(F.lit(1)).alias("clips"),
            F.sum("duration_ms").alias("duration_ms"),
        )
        .withColumn("hours", F.col("duration_ms") / F.lit(_MS_PER_HOUR))
        .withColumn(
            "optimizer_steps",
            F.call_function("div", F.col("clips") + (effective - 1), F.lit(effective)) * epochs,
        )
    )
