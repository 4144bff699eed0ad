"""Clips and hearings that arrive in any order, deadlines, and the array form of the speaker test."""

import random

import pytest
from pyspark.sql import functions as F

from clipcurate.operators import verdict
from clipcurate.operators.segments import single_speaker, single_speaker_of
from clipcurate.plans.curate import Curator
from clipcurate.sources.ledger import read_ledger
from clipcurate.streaming.speakers import curate_stream_with_speakers, with_hearings

SEGMENT = "array<struct<start_us:long,end_us:long,speaker:string>>"
HEARING = f"language string, id string, segments {SEGMENT}, status string, arrived timestamp"


def test_array_form_equals_the_table_form(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        segments = []
        for _ in range(rng.randint(0, 4)):
            start = rng.randint(0, 12)
            segments.append((start, start + rng.randint(-1 if i % 50 == 0 else 0, 4), rng.choice("AAAAB")))
        if i % 17 == 0:
            segments.append((None, None, None))
        if i % 41 == 0:
            segments.append((3, None, "A"))
        rows.append((f"c{i}", segments, "failed" if i % 29 == 0 else "ok"))
    heard = spark.createDataFrame(rows, f"clip_id string, segments {SEGMENT}, status string")
    found = {r.clip_id: r.x for r in heard.select("clip_id", single_speaker_of(F.col("segments"), F.col("status")).alias("x")).collect()}
    table = heard.select("clip_id", "status", F.explode_outer("segments").alias("s")).select("clip_id", "s.*", "status")
    assert found == {r.clip_id: r.single_speaker for r in single_speaker(table).collect()}


@pytest.fixture
def run(spark, tmp_path, make_clips):
    def add(name, rows, hour):
        rows.withColumn("arrived", F.timestamp_seconds(F.lit(hour * 3600))).coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    def deliver(hour, clips=(), hearings=()):
        add("clips", make_clips(*clips), hour)
        heard = spark.createDataFrame([("gu", i, s, status, None) for i, s, status in hearings], HEARING)
        add("hearings", heard.drop("arrived"), hour)
        streams = [
            spark.readStream.schema(spark.read.parquet(str(tmp_path / n)).schema).parquet(str(tmp_path / n))
            for n in ("clips", "hearings")
        ]
        curate_stream_with_speakers(*streams, str(tmp_path / "ledger"), str(tmp_path / "progress"), wait="2 hours").awaitTermination()
        return {r.id: r.verdict for r in read_ledger(spark, str(tmp_path / "ledger")).collect()}

    return deliver


TEXT = "x" * 30
ONE, TWO = [(0, 1, "A"), (1, 2, "A")], [(0, 1, "A"), (1, 2, "B")]


def test_clips_wait_for_their_hearing_or_the_deadline(run):
    clips = [(i, "gu", TEXT, 3) for i in ("after", "before", "never", "failed")] + [("short", "gu", TEXT, 1)]
    found = run(1, clips[:1] + clips[2:], [("before", TWO, "ok")])
    assert found == {"short": "duration_rejected"}  # needs no hearing
    found = run(2, clips[1:2], [("after", ONE, "ok"), ("failed", ONE, "error")])
    assert found == {
        "short": "duration_rejected", "after": "kept", "before": "multi_speaker_rejected", "failed": "multi_speaker_rejected",
    }
    found = run(9, [("late", "gu", TEXT, 3)], [("other", ONE, "ok")])
    assert found["never"] == "kept"  # as a clip without a diarization in a batch run
    assert "late" not in found
    found = run(10, [("after", "gu", TEXT, 1)], [("late", TWO, "ok")])
    assert found["late"] == "multi_speaker_rejected" and found["after"] == "kept"
    assert len(found) == 6


def test_runs_without_news_change_nothing(run):
    first = run(1, [("a", "gu", TEXT, 3)], [("a", ONE, "ok"), ("a", ONE, "ok")])
    assert first == {"a": "kept"}
    assert run(1) == first


def test_clips_wait_if_their_measured_verdict_keeps_them(make_clips):
    texts = (None, "", " |> ", "x", "x" * 30, "x " * 40, "x" * 600)
    rows = [(f"{n}-{s}", "gu", text, s) for n, text in enumerate(texts) for s in (None, 0, 1.9, 2, 7.5, 20, 20.1)]
    clips, config = make_clips(*rows), Curator().config
    clips = clips.union(clips.withColumn("sampling_rate", F.lit(0)))
    kept = verdict.with_measures(clips).where(verdict.measured_verdict(config) == verdict.KEPT)
    found = clips.where(verdict.passes_measured(config))
    key = lambda rows: sorted((r.id, r.sampling_rate) for r in rows.collect())
    assert key(found) == key(kept) and 0 < found.count() < clips.count()
    assert found.count() + clips.where(~verdict.passes_measured(config)).count() == clips.count()


def test_a_text_is_cleaned_once_on_each_way(spark, make_clips):
    arrived = F.timestamp_seconds(F.lit(3600)).alias("arrived")
    clips = make_clips(("a", "gu", TEXT, 3)).select("*", arrived)
    both = with_hearings(clips, spark.createDataFrame([], HEARING), Curator(), "1 hour", "0 seconds")
    assert both._jdf.queryExecution().analyzed().toString().count("translate(") == 2
    assert both._jdf.queryExecution().optimizedPlan().toString().count("translate(") <= 2
