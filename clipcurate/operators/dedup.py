"""Keep-first handling of repeated clip ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLIP_KEY = ("language", "id")
SOURCE_ORDER = ("src_file", "src_row")


def keep_first(
    clips: DataFrame,
    key: tuple[str, ...] = CLIP_KEY,
    order: tuple[str, ...] = SOURCE_ORDER,
) -> DataFrame:
    """One row per key, the earliest in source order, with the number of `copies` it stands for.

    Rows that have `copies` already, because a part of them was folded before, add theirs up.

    An aggregate, not a ranking: every map task first folds its own copies into one row, so an id that
    holds a large share of the table still reaches its reducer as one row per map task. Audio does not
    belong here; pass the narrow columns and join the bytes later by source position.
    """
    rest = [c for c in clips.columns if c not in key and c != "copies"]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    copies = F.sum("copies") if "copies" in clips.columns else F.count(F.lit(1))
    folded = clips.groupBy(*key).agg(first.alias("_first"), copies.alias("copies"))
    return folded.select(*key, *[F.col(f"_first.{c}").alias(c) for c in rest], "copies")
