"""Skipping work that a ledger already records."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcurate.operators.dedup import CLIP_KEY, keep_first
from clipcurate.session import written

# Up to this many new ids are sent to the ledger scan; beyond it both sides are shuffled.
IDS_TO_BROADCAST = 200_000
# An id that has more copies than this, and more than one in `HOT_IDS` of all rows, is folded before it is shuffled.
COPIES_TO_SHIP = 1_000
HOT_IDS = 100_000


def not_processed(clips: DataFrame, ledger: DataFrame, key: tuple[str, ...] = CLIP_KEY) -> DataFrame:
    return clips.join(ledger.select(*key), list(key), "left_anti")


def not_processed_small(
    clips: DataFrame,
    ledger: DataFrame,
    key: tuple[str, ...] = CLIP_KEY,
    used: list[str] | None = None,
) -> DataFrame:
    """As `not_processed`, for a small batch against a large ledger that should not be shuffled.

    The batch's ids, if few, are sent to the ledger scan, and only the ledger rows they hit come back. The folder of the written ids is added to `used`, for the caller to release.
    """
    ids = written(clips.select(*key).distinct(), "ids", used)
    if ids.count() > IDS_TO_BROADCAST:
        return not_processed(clips, ledger, key)
    hits = ledger.select(*key).join(F.broadcast(ids), list(key), "left_semi").distinct()
    return clips.join(hits, list(key), "left_anti")


def seen_ids(clips: DataFrame, ledger: DataFrame, key: tuple[str, ...], used: list[str] | None = None) -> DataFrame:
    """Each key of `clips` once, with the number of its `copies` and whether it is `done`, that is in the ledger.

    A key with a null is never done. The rows are narrow and written, to the folder that is added to `used`.
    """
    counts = clips.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    known = ledger.select(*key).distinct().withColumn("_known", F.lit(True))
    rows = counts.join(known, list(key), "left")
    return written(rows.select(*key, "copies", F.col("_known").isNotNull().alias("done")), "seen-ids", used)


def among(clips: DataFrame, ids: DataFrame, key: tuple[str, ...], how: str = "left_semi") -> DataFrame:
    """The clips whose key is among a few `ids`, or with "left_anti" the others. A null equals a null."""
    return clips.join(F.broadcast(ids), reduce(and_, [clips[c].eqNullSafe(ids[c]) for c in key]), how)


def hot_folded(clips: DataFrame, ids: DataFrame, rows: int, key: tuple[str, ...]) -> DataFrame:
    """`clips` with `copies`, where ids with very many copies among these `rows` are one row already.

    Those are `HOT_IDS` at most, so they are sent to the scan, and their copies are folded in the task that reads them.
    """
    hot = ids.where(F.col("copies") > max(COPIES_TO_SHIP, rows // HOT_IDS)).select(*key)
    if hot.isEmpty():
        return clips.withColumn("copies", F.lit(1).cast("long"))
    rare = among(clips, hot, key, "left_anti").withColumn("copies", F.lit(1).cast("long"))
    return rare.unionByName(keep_first(among(clips, hot, key), key))


def is_complete(ledger: DataFrame, language: str) -> bool:
    """Completeness is asked per language: one finished language says nothing about another."""
    return not ledger.where(F.col("language") == language).limit(1).isEmpty()
