"""Resumable curation of a growing folder with Structured Streaming."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clipcurate.operators import verdict
from clipcurate.operators.resume import not_processed_small
from clipcurate.plans.curate import Curator
from clipcurate.plans.increments import record_copies
from clipcurate.session import release_scratch, written
from clipcurate.sinks.tables import write_ledger
from clipcurate.sources.ledger import bucket_of, read_ledger


def read_stream_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    return read_ledger(spark, ledger_path)


def batch_key(checkpoint: str, batch_id: int) -> str:
    """A micro-batch is known by its stream, that is its checkpoint, and its number there."""
    return f"stream-{hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()[:12]}-{batch_id}"


def curate_stream(
    clips: DataFrame,
    ledger_path: str,
    checkpoint: str,
    curator: Curator = Curator(),
    diarization: DataFrame | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Curate what has arrived since the last run, then stop.

    The ledger is the only memory of past ids, so no streaming state grows with the data. It may hold the rows of
    batch runs and of other streams as well; only the buckets of the batch's ids are read. Each batch replaces its own ledger folder: redoing a batch after a
    crash gives the same rows once. A limit on the number of clips is refused, as it would hold for each
    micro-batch and depend on how files arrive.
    """
    if curator.config.max_samples:
        raise ValueError("a stream has no first clips: max_samples cannot be used")

    def record(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        key = batch_key(checkpoint, batch_id)
        scratch: list[str] = []
        rows = written(prepare(batch), "batch", scratch)
        buckets = [r[0] for r in rows.select(bucket_of(F.col("id"))).distinct().collect()]
        done = read_ledger(spark, ledger_path, without=key, buckets=buckets)
        skip = partial(not_processed_small, used=scratch)
        write_ledger(curator.verdicts(rows, diarization, done, skip=skip), ledger_path, key)
        record_copies(verdict.in_languages(rows, curator.config.languages), ledger_path, key, buckets)
        release_scratch(spark, scratch)

    return (
        clips.writeStream.foreachBatch(record)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
