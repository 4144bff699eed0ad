"""Packed clips, ledgers, statistics and logs."""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcurate.functions.names import shard_name
from clipcurate.operators.pack import with_defaults
from clipcurate.schemas import BUCKET, CLEAN_CLIP, LEDGER, RUN_KEY
from clipcurate.sources.ledger import bucket_of

# Fixed value: the folder of packed shards.
SHARD_FOLDER = "data/train"


def packed_rows(sharded: DataFrame, audio: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
    """Packed clips with their real sampling rate; audio joins last, by its place in the source.

    A source position is unique, so a repeated id does not fill one task. Id and language have to match too: a ledger
    written for another folder then loses its clips instead of giving them other recordings. `audio` tables without
    these two columns are joined by position alone. `keys` names other columns to join by.
    """
    place = list(keys or [c for c in ("src_file", "src_row", "language", "id") if c in audio.columns])
    rows = with_defaults(sharded).join(audio.select(*place, "audio"), place)
    return rows.select(
        "id",
        "audio",
        "text",
        "language",
        (F.col("duration_ms") / F.lit(1000.0)).alias("duration_sec"),
        F.col("speaker").alias("speaker_id"),
        F.round("cps", 2).alias("cps"),
        "shard_id",
        "row_no",
    )


def write_shards(rows: DataFrame, path: str) -> str:
    """One snappy file per shard, in row order, under `data/train/shard=shard_NNNNN`."""
    out = f"{path.rstrip('/')}/{SHARD_FOLDER}"
    columns = [F.col(f.name).cast(f.dataType) for f in CLEAN_CLIP.fields]
    (
        rows.withColumn("shard", shard_name(F.col("shard_id")))
        .repartition("shard")
        .sortWithinPartitions("shard", "row_no")
        .select(*columns, "shard")
        .write.mode("overwrite")
        .option("compression", "snappy")
        .partitionBy("shard")
        .parquet(out)
    )
    return out


def ledger_part(path: str, key: str) -> str:
    """The folder of one writer's rows. Batches and streams use the same layout and never share a folder."""
    return f"{path.rstrip('/')}/{RUN_KEY}={quote(key, safe='')}"


def write_ledger(verdicts: DataFrame, path: str, key: str) -> None:
    """Write the verdict rows of one writer, a folder per bucket; doing it again with the same key replaces them.

    Rows that come with their bucket are written from where they lie.
    """
    columns = [F.col(f.name).cast(f.dataType) for f in LEDGER.fields]
    if BUCKET in verdicts.columns:
        bucketed = verdicts.select(*columns, BUCKET)
    else:
        bucketed = verdicts.select(*columns, bucket_of(F.col("id")).alias(BUCKET)).repartition(BUCKET)
    bucketed.write.mode("overwrite").partitionBy(BUCKET).parquet(ledger_part(path, key))


def append_ledger(verdicts: DataFrame, path: str, run_id: str) -> str:
    """Add the verdict rows of one run. Every call has a folder of its own, so runs side by side do not meet."""
    key = f"{run_id}.{uuid.uuid4().hex[:12]}"
    write_ledger(verdicts.withColumn("run_id", F.lit(run_id)), path, key)
    return key


def write_stats(stats: DataFrame, path: str) -> None:
    """A few aggregate rows as JSON lines."""
    stats.coalesce(1).write.mode("overwrite").json(path)


def write_generation_log(log: DataFrame, path: str) -> None:
    """JSON lines in UTF-8, one folder per reference voice; a missing file is written as null."""
    log.write.mode("overwrite").option("ignoreNullFields", False).partitionBy("ref_name").json(path)
