"""A ledger that grows by runs and micro-batches: later copies, counts kept up by increments, and compaction."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipcurate.operators.dedup import CLIP_KEY, SOURCE_ORDER
from clipcurate.operators.verdict import DUPLICATE
from clipcurate.schemas import BUCKET, COUNTS, GENERATIONS, LEDGER, RUN_KEY
from clipcurate.session import delete_folder
from clipcurate.sinks.tables import ledger_part
from clipcurate.sources.ledger import (
    COUNTS_SUFFIX,
    DUPLICATES_SUFFIX,
    GENERATION,
    GENERATIONS_SUFFIX,
    beside,
    read_duplicates,
    read_ledger,
    read_or_empty,
    stored_ledger,
)

_STREAM_BATCH = re.compile(r"(stream-[0-9a-f]+)-(\d+)")


def copies_of(rows: DataFrame, ledger: DataFrame, duplicates: DataFrame) -> DataFrame:
    """The rows that are recorded nowhere yet, by their source position, as further copies: their clips are recorded.

    Clips that a ledger records without a position, as imported ones, have no copies: they may be these themselves.
    Since the ledger has every clip of the rows, only those few are looked for, and among new copies alone.
    """
    place = [*CLIP_KEY, *SOURCE_ORDER]
    known = ledger.select(*place).union(duplicates.select(*place))
    named = rows.select(*place).where(F.col("language").isNotNull() & F.col("id").isNotNull())
    found = named.join(known, place, "left_anti").distinct()
    unplaced = ledger.where(F.col("src_file").isNull()).select(*CLIP_KEY)
    if unplaced.isEmpty():
        return found
    placed = ledger.where(F.col("src_file").isNotNull()).select(*CLIP_KEY)
    return found.join(unplaced.join(placed, list(CLIP_KEY), "left_anti"), list(CLIP_KEY), "left_anti")


def record_copies(
    rows: DataFrame, ledger_path: str, key: str, buckets: list[int] | None = None
) -> None:
    """Record the further copies among `rows`, whose first ones are in the ledger by now, under the key of their run.

    Doing it again gives the same, and a run that was cut off before it leaves them to the next one over these rows.
    """
    spark = rows.sparkSession
    ledger = read_ledger(spark, ledger_path, buckets=buckets)
    found = copies_of(rows, ledger, read_duplicates(spark, ledger_path, without=key))
    found.write.mode("overwrite").parquet(ledger_part(beside(ledger_path, DUPLICATES_SUFFIX), key))


def read_counts(spark: SparkSession, ledger_path: str, own: str | None = None) -> DataFrame:
    """(language, verdict, clips, duration_ms) of all that is recorded, after counting what is not counted yet.

    Each run's and micro-batch's part is counted once, when it is first asked for; later calls add up these few rows.
    Runs side by side may count the same part, or one that is still growing: every call writes a folder of its own, a
    run counts its `own` part at its end in any case, and the largest count of a part is the one that holds.
    """
    path = beside(ledger_path, COUNTS_SUFFIX)
    counted = read_or_empty(spark, path, COUNTS)
    known = {r[0] for r in counted.select(RUN_KEY).distinct().collect()} - {own}
    rows = stored_ledger(spark, ledger_path).where(~F.startswith(RUN_KEY, F.lit(GENERATION)))
    rows = rows.select(RUN_KEY, "language", "verdict", "duration_ms")
    copies = read_or_empty(spark, beside(ledger_path, DUPLICATES_SUFFIX), f"language string, {RUN_KEY} string")
    both = rows.union(copies.select(RUN_KEY, "language", F.lit(DUPLICATE), F.lit(None).cast("long")))
    new = both.where(~F.col(RUN_KEY).isin(*known)).groupBy(RUN_KEY, "language", "verdict")
    new = new.agg(F.count(F.lit(1)).alias("clips"), F.coalesce(F.sum("duration_ms"), F.lit(0)).alias("duration_ms"))
    new.coalesce(1).write.parquet(f"{path}/part={uuid.uuid4().hex}")
    parts = spark.read.schema(COUNTS).parquet(path).groupBy(RUN_KEY, "language", "verdict")
    counts = parts.agg(F.max("clips").alias("clips"), F.max("duration_ms").alias("duration_ms"))
    return counts.groupBy("language", "verdict").agg(F.sum("clips").alias("clips"), F.sum("duration_ms").alias("duration_ms"))


def compact_ledger(spark: SparkSession, ledger_path: str) -> str | None:
    """Put the run folders of a ledger together, one file a bucket; returns the key of the new folder, if there is one.

    The newest micro-batch of each stream stays as it is, as it may run again and replace its rows. The new folder counts
    from the moment it is recorded, and the old ones are then deleted, so a crash at any point loses and doubles nothing.
    """
    read_counts(spark, ledger_path)
    rows = stored_ledger(spark, ledger_path)
    keys = {r[0] for r in rows.select(RUN_KEY).distinct().collect()}
    newest: dict[str, int] = {}
    for match in filter(None, map(_STREAM_BATCH.fullmatch, keys)):
        newest[match[1]] = max(newest.get(match[1], -1), int(match[2]))
    old = sorted(keys - {f"{stream}-{batch}" for stream, batch in newest.items()})
    if len(old) < 2:
        return None
    key = GENERATION + uuid.uuid4().hex[:12]
    chosen = rows.where(F.col(RUN_KEY).isin(*old)).select(*LEDGER.fieldNames(), BUCKET)
    chosen.repartition(BUCKET).write.partitionBy(BUCKET).parquet(ledger_part(ledger_path, key))
    record = spark.createDataFrame([(key, k) for k in old], GENERATIONS)
    record.coalesce(1).write.mode("append").parquet(beside(ledger_path, GENERATIONS_SUFFIX))
    for name in old:
        delete_folder(spark, ledger_part(ledger_path, name))
    return key
