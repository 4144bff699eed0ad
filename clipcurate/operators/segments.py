"""Single-speaker test over diarization segments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Width of one time slice; longer than any clip that is kept, so that most clips have one slice.
SLICE_US = 30_000_000


def clip_key(rows: DataFrame) -> list[str]:
    """What names a clip in a diarization table. Ids repeat between languages, so a language belongs to it if known."""
    return [c for c in ("language", "clip_id") if c in rows.columns]


def diarization_rows(segments: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """One diarization table from a segments table and an optional per-clip status table."""
    key = clip_key(segments)
    rows = segments.select(*key, "start_us", "end_us", "speaker", F.lit("ok").alias("status"))
    if status is None:
        return rows
    return rows.unionByName(status.select(*key, "status"), allowMissingColumns=True)


def overlap_profile(diarization: DataFrame, slice_us: int = SLICE_US) -> DataFrame:
    """Per clip: has any pair of segments a common instant, is there one speaker at most, did it fail.

    Two segments overlap when each starts before the other ends; touching ends do not count and the
    speakers are not compared. In (start, end) order it is enough to look at neighbours: if no segment
    starts before its predecessor ends, the ends grow too and no pair overlaps. To keep a clip with very
    many segments out of a single task,

    1. equal starts are folded first (map-side, so copies never travel),
    2. neighbours are compared inside each time slice of the clip,
    3. slices, now one row each, are compared with the slice before them.

    A segment that ends before it starts, or has only one bound, is unusable output: the clip fails.
    """
    key = clip_key(diarization)
    start, end = F.col("start_us"), F.col("end_us")
    unusable = (start.isNull() != end.isNull()) | F.coalesce(end < start, F.lit(False))
    folded = (
        diarization.select(
            *key,
            F.call_function("div", start, F.lit(slice_us).cast("long")).alias("slice"),
            "start_us",
            "end_us",
            "speaker",
            (unusable | (F.col("status") != "ok")).alias("bad"),
        )
        .groupBy(*key, "slice", "start_us", "speaker")
        .agg(
            F.max("end_us").alias("end_us"),
            F.count_if(end > start).alias("positive"),
            F.max("bad").alias("bad"),
        )
    )
    in_slice = Window.partitionBy(*key, "slice").orderBy("start_us", "end_us")
    slices = (
        folded.withColumn("end_before", F.lag("end_us").over(in_slice))
        .groupBy(*key, "slice")
        .agg(
            F.min("start_us").alias("first_start"),
            F.max("end_us").alias("last_end"),
            F.min("speaker").alias("low_speaker"),
            F.max("speaker").alias("high_speaker"),
            F.bool_or(
                (F.col("positive") > 1) | F.coalesce(start < F.col("end_before"), F.lit(False))
            ).alias("inner_overlap"),
            F.bool_or("bad").alias("bad"),
        )
    )
    in_clip = Window.partitionBy(*key).orderBy("slice")
    return (
        slices.withColumn("end_before", F.lag("last_end").over(in_clip))
        .groupBy(*key)
        .agg(
            F.coalesce(F.min("low_speaker") == F.max("high_speaker"), F.lit(True)).alias(
                "at_most_one_speaker"
            ),
            F.bool_or(
                F.col("inner_overlap")
                | F.coalesce(F.col("first_start") < F.col("end_before"), F.lit(False))
            ).alias("has_overlap"),
            F.bool_or("bad").alias("failed"),
        )
    )


def speaker_counts(diarization: DataFrame) -> DataFrame:
    """Distinct speakers per clip; repeated labels are folded before they are shuffled."""
    return diarization.groupBy(*clip_key(diarization)).agg(F.countDistinct("speaker").alias("speakers"))


def single_speaker(diarization: DataFrame, slice_us: int = SLICE_US) -> DataFrame:
    """The clip's key and `single_speaker`. A clip without segments passes unless its diarization failed."""
    profile = overlap_profile(diarization, slice_us)
    passes = F.col("at_most_one_speaker") & ~F.col("has_overlap") & ~F.col("failed")
    return profile.select(*clip_key(profile), passes.alias("single_speaker"))


def single_speaker_of(segments: Column, status: Column) -> Column:
    """The same test of one clip whose segments `(start_us, end_us, speaker)` are an array in its row.

    Segments without bounds are silence. A null array is a clip without segments.
    """
    here = F.filter(
        F.coalesce(segments, F.array()), lambda s: s["start_us"].isNotNull() | s["end_us"].isNotNull()
    )
    failed = F.coalesce(status != "ok", F.lit(True))
    return _named(here, _one_at_a_time) & ~failed


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, where the value is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _one_at_a_time(here: Column) -> Column:
    """One speaker at most, no two segments with a common instant, and none that is unusable."""
    bad = F.exists(
        here,
        lambda s: (s["start_us"].isNull() != s["end_us"].isNull()) | F.coalesce(s["end_us"] < s["start_us"], F.lit(False)),
    )
    bounds = F.array_sort(F.transform(here, lambda s: F.struct(s["start_us"].alias("start"), s["end_us"].alias("end"))))
    speakers = F.array_distinct(F.filter(F.transform(here, lambda s: s["speaker"]), lambda x: x.isNotNull()))
    return (F.size(speakers) <= 1) & ~bad & ~_named(bounds, _neighbours_overlap)


def _neighbours_overlap(ordered: Column) -> Column:
    neighbours = F.arrays_zip(ordered.alias("a"), F.slice(ordered, 2, F.greatest(F.size(ordered), F.lit(1))).alias("b"))
    return F.exists(neighbours, lambda n: F.coalesce(n["b"]["start"] < n["a"]["end"], F.lit(False)))
