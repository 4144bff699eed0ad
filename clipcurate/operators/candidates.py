"""Flags and choices over kept clips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcurate.config import PROMPT_SECONDS, REFERENCE_MAX_S, REFERENCE_MIN_S
from clipcurate.operators.ordering import top_per_group


def is_degenerate(duration: Column, prompt_seconds: float = PROMPT_SECONDS) -> Column:
    """A clip that the prompt covers whole leaves nothing to train on."""
    return duration <= prompt_seconds


def reference_candidates(
    kept: DataFrame,
    k: int,
    min_s: int = REFERENCE_MIN_S,
    max_s: int = REFERENCE_MAX_S,
) -> DataFrame:
    """The k clips per language nearest to the middle of the reference band, then by id."""
    middle_ms = (min_s + max_s) * 500
    fitting = kept.where(F.col("duration").between(min_s, max_s)).withColumn(
        "distance_ms", F.abs(F.col("duration_ms") - middle_ms)
    )
    return top_per_group(fitting, "language", k, "distance_ms", "id")
