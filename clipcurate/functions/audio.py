"""Duration and speaking-rate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_seconds(frames: Column, rate: Column) -> Column:
    """Unrounded seconds; null when the clip could not be decoded."""
    return F.when(rate > 0, frames.cast("double") / rate.cast("double"))


def duration_ms(frames: Column, rate: Column) -> Column:
    """Half-up milliseconds in integer arithmetic, so that sums do not depend on order."""
    twice_rate = rate.cast("long") * 2
    scaled = frames.cast("long") * 2000 + rate
    return F.when(rate > 0, F.call_function("div", scaled, twice_rate))


def chars_per_second(text: Column, duration: Column) -> Column:
    return F.when(duration <= 0, F.lit(0.0)).otherwise(F.length(text).cast("double") / duration)
