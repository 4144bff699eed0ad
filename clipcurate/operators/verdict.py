"""The filter chain: each clip is charged to the first test it fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcurate.config import CurationConfig
from clipcurate.functions.audio import chars_per_second, duration_ms, duration_seconds
from clipcurate.functions.text import clean_text
from clipcurate.schemas import BUCKET, PART

# The verdicts, in the order of the tests.
TEXT_REJECTED = "text_rejected"
DECODE_ERROR = "decode_error"
DURATION_REJECTED = "duration_rejected"
CPS_REJECTED = "cps_rejected"
MULTI_SPEAKER_REJECTED = "multi_speaker_rejected"
KEPT = "kept"
VERDICTS = (
    TEXT_REJECTED,
    DECODE_ERROR,
    DURATION_REJECTED,
    CPS_REJECTED,
    MULTI_SPEAKER_REJECTED,
    KEPT,
)

# What partial counts call a later copy of a clip; no clip has it as its verdict.
DUPLICATE = "duplicate"


def in_languages(clips: DataFrame, languages: tuple[str, ...] | None) -> DataFrame:
    return clips if languages is None else clips.where(F.col("language").isin(*languages))


def with_measures(clips: DataFrame) -> DataFrame:
    """Cleaned text, duration and speaking rate; filters use the unrounded values."""
    frames, rate = F.col("frames"), F.col("sampling_rate")
    return (
        clips.withColumn("clean_text", clean_text(F.col("text")))
        .withColumn("duration", duration_seconds(frames, rate))
        .withColumn("duration_ms", duration_ms(frames, rate))
        .withColumn("cps", chars_per_second(F.col("clean_text"), F.col("duration")))
    )


def text_ok(config: CurationConfig) -> Column:
    return F.coalesce(F.length("clean_text") >= config.min_text_chars, F.lit(False))


def duration_ok(config: CurationConfig) -> Column:
    return F.col("duration").between(config.min_duration_s, config.max_duration_s)


def cps_ok(config: CurationConfig) -> Column:
    return F.col("cps").between(config.min_cps, config.max_cps)


def measured_verdict(config: CurationConfig) -> Column:
    """The verdict before speakers are known; every test here is local to the row."""
    return (
        F.when(~text_ok(config), TEXT_REJECTED)
        .when(F.col("duration").isNull(), DECODE_ERROR)
        .when(~duration_ok(config), DURATION_REJECTED)
        .when(~cps_ok(config), CPS_REJECTED)
        .otherwise(KEPT)
    )


def passes_measured(config: CurationConfig) -> Column:
    """Whether `measured_verdict` keeps a clip, asked of its source columns; true or false, never null.

    For a filter. Spark moves it below the columns it reads, so that a text would be cleaned at every mention of its
    length; here it is cleaned once.
    """
    duration = duration_seconds(F.col("frames"), F.col("sampling_rate"))
    passes = lambda text: (
        F.coalesce(F.length(text) >= config.min_text_chars, F.lit(False))
        & duration.between(config.min_duration_s, config.max_duration_s)
        & chars_per_second(text, duration).between(config.min_cps, config.max_cps)
    )
    return F.coalesce(F.exists(F.array(clean_text(F.col("text"))), passes), F.lit(False))


def apply_speakers(
    measured: DataFrame, speakers: DataFrame | None, languages: tuple[str, ...] | None = None
) -> DataFrame:
    """Reject kept clips whose speakers failed. Without a speakers table the join is not planned.

    Speakers with a language join by it. In a run over one language theirs are picked first, and the id alone joins,
    which shares the shuffle of the copies. Tables that lie by bucket are joined where they lie.
    """
    if speakers is None:
        return measured
    key = ["id"]
    if "language" in speakers.columns:
        if languages is not None and len(languages) == 1:
            speakers = in_languages(speakers, languages).drop("language")
        else:
            key = ["language", "id"]
    key = [*[c for c in (BUCKET, PART) if c in speakers.columns], *key]
    # Clips that pass need not be met, so they are not shuffled.
    speakers = speakers.where(~F.col("single_speaker"))
    failed = ~F.coalesce(F.col("single_speaker"), F.lit(True))
    verdict = F.when((F.col("verdict") == KEPT) & failed, MULTI_SPEAKER_REJECTED).otherwise(
        F.col("verdict")
    )
    return (
        measured.join(speakers.withColumnRenamed("clip_id", "id"), key, "left")
        .withColumn("verdict", verdict)
        .drop("single_speaker")
    )
