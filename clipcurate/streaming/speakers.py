"""Curation of a stream of clips whose speaker segments arrive on a stream of their own, before or after their clip."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clipcurate.operators import verdict
from clipcurate.operators.dedup import CLIP_KEY
from clipcurate.operators.resume import not_processed_small
from clipcurate.operators.segments import single_speaker_of
from clipcurate.plans.curate import Curator
from clipcurate.session import release_scratch, written
from clipcurate.sinks.tables import write_ledger
from clipcurate.sources.ledger import read_ledger
from clipcurate.streaming.curate import batch_key


def with_hearings(clips: DataFrame, hearings: DataFrame, curator: Curator, wait: str, late: str) -> DataFrame:
    """Clips with `single_speaker` as soon as it is known or need not be.

    A clip that fails a cheaper test does not wait. One that passes them is held in state until the hearing of its
    language and id arrives, at most `wait` earlier or later than itself; when the watermark has passed that deadline
    it goes on without one, with null. So state holds the clips and hearings of two such spans of time.
    """
    arriving = verdict.in_languages(clips, curator.config.languages).withWatermark("arrived", late)
    waits = verdict.passes_measured(curator.config)
    heard = hearings.select(
        F.col("language").alias("_language"),
        F.col("id").alias("_id"),
        F.col("arrived").alias("_heard"),
        single_speaker_of(F.col("segments"), F.col("status")).alias("single_speaker"),
    ).withWatermark("_heard", late)
    in_time = F.expr(f"_heard >= arrived - interval {wait} and _heard <= arrived + interval {wait}")
    same = (F.col("language") == F.col("_language")) & (F.col("id") == F.col("_id"))
    columns = [*clips.columns, "single_speaker"]
    held = arriving.where(waits).join(heard, same & in_time, "left_outer")
    at_once = arriving.where(~waits).withColumn("single_speaker", F.lit(None).cast("boolean"))
    return at_once.select(*columns).union(held.select(*columns))


def curate_stream_with_speakers(
    clips: DataFrame,
    hearings: DataFrame,
    ledger_path: str,
    checkpoint: str,
    curator: Curator = Curator(),
    wait: str = "1 hour",
    late: str = "0 seconds",
) -> StreamingQuery:
    """Curate what has arrived on both streams since the last run, then stop.

    `clips` are narrow clips and `hearings` rows `(language, id, segments array<struct<start_us, end_us, speaker>>,
    status)`, one per clip; both have the time they `arrived`. A clip is recorded once its speakers are known, or at the
    deadline, when it passes as a clip without a diarization does in a batch run. Clips that still wait when the run
    stops are in the checkpoint, and the next run goes on with them. Several hearings of a clip have to agree that it
    has one speaker. Ids that the ledger has are left out, and a batch that runs again replaces its own rows.
    """
    if curator.config.max_samples:
        raise ValueError("a stream has no first clips: max_samples cannot be used")

    def record(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        key = batch_key(checkpoint, batch_id)
        scratch: list[str] = []
        rows = written(batch, "stream-batch", scratch)
        done = read_ledger(spark, ledger_path, without=key)
        speakers = rows.groupBy(*CLIP_KEY).agg(F.bool_and("single_speaker").alias("single_speaker"))
        measured = curator.measured(
            rows.drop("single_speaker", "arrived").distinct(), done, skip=partial(not_processed_small, used=scratch)
        )
        judged = verdict.apply_speakers(measured, speakers.withColumnRenamed("id", "clip_id"))
        write_ledger(judged.withColumn("run_id", F.lit(curator.config.run_id)), ledger_path, key)
        release_scratch(spark, scratch)

    return (
        with_hearings(clips, hearings, curator, wait, late)
        .writeStream.foreachBatch(record)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
