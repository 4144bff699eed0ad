import random

import pytest
from pyspark.sql import functions as F

from clipcurate.config import CurationConfig
from clipcurate.functions.names import wav_path
from clipcurate.operators import candidates, dedup, funnel, pack, resume, segments
from clipcurate.plans.curate import Curator
from clipcurate.streaming.curate import curate_stream, read_stream_ledger

GOOD = "x" * 30


def by_id(df, value="verdict"):
    return {r["id"]: r[value] for r in df.collect()}


def test_first_failing_test_is_charged(make_clips):
    clips = make_clips(
        ("ok", "gu", GOOD, 3.0),
        ("none", "gu", None, 3.0),
        ("empty", "gu", " >| ", 3.0),
        ("one", "gu", "a", 1.0),
        ("two", "gu", "ab", 0.5),
        ("broken", "gu", GOOD, None),
        ("short", "gu", GOOD, 1.999),
        ("long", "gu", GOOD, 20.001),
        ("slow", "gu", "abcdefg", 2.0),
        ("fast", "gu", "y" * 51, 2.0),
        ("zero", "gu", GOOD, 0.0),
    )
    assert by_id(Curator().verdicts(clips)) == {
        "ok": "kept",
        "none": "text_rejected",
        "empty": "text_rejected",
        "one": "text_rejected",
        "two": "duration_rejected",
        "broken": "decode_error",
        "short": "duration_rejected",
        "long": "duration_rejected",
        "slow": "cps_rejected",
        "fast": "cps_rejected",
        "zero": "duration_rejected",
    }


def test_band_edges_are_kept(make_clips):
    clips = make_clips(
        ("d2", "gu", "x" * 20, 2.0),
        ("d20", "gu", "x" * 200, 20.0),
        ("cps4", "gu", "x" * 8, 2.0),
        ("cps25", "gu", "x" * 50, 2.0),
    )
    assert set(by_id(Curator().verdicts(clips)).values()) == {"kept"}


def test_repeated_id_is_dropped_even_after_a_rejected_first_row(make_clips):
    clips = make_clips(
        ("a", "gu", GOOD, 0.5), ("a", "gu", GOOD, 3.0), ("a", "hi", GOOD, 3.0), ("b", "gu", GOOD, 3.0)
    )
    rows = Curator(CurationConfig(languages=("gu",))).verdicts(clips)
    assert by_id(rows) == {"a": "duration_rejected", "b": "kept"}
    assert by_id(rows, "copies") == {"a": 2, "b": 1}


def test_funnel_adds_up(make_clips):
    clips = make_clips(
        ("a", "gu", GOOD, 3.0), ("a", "gu", GOOD, 4.0), ("b", "gu", "", 3.0), ("c", "gu", GOOD, 0.1),
        ("d", "gu", GOOD, None), ("e", "gu", "z" * 4, 19.0), ("f", "gu", GOOD, 3.0), ("g", "hi", GOOD, 3.0),
    )
    speakers = [("f", 0, 10, "A", "ok"), ("f", 20, 30, "B", "ok")]
    diar = clips.sparkSession.createDataFrame(
        speakers, "clip_id string, start_us long, end_us long, speaker string, status string"
    )
    row = Curator(CurationConfig(languages=("gu",))).run(clips, diar).funnel.first().asDict()
    assert row == {
        "total": 8, "lang_filtered": 7, "duplicates": 1, "text_rejected": 1, "decode_error": 1,
        "duration_rejected": 1, "cps_rejected": 1, "multi_speaker_rejected": 1, "kept": 1,
    }
    parts = [v for k, v in row.items() if k not in ("total", "lang_filtered")]
    assert sum(parts) == row["lang_filtered"]


def test_empty_input_gives_zero_counts(make_clips):
    clips = make_clips(("a", "gu", GOOD, 3.0)).where("false")
    row = Curator().run(clips).funnel.first()
    assert set(row.asDict().values()) == {0}


def test_sample_limit_is_a_prefix_of_the_language(make_clips):
    clips = make_clips(
        ("h", "hi", GOOD, 3.0), ("a", "gu", GOOD, 3.0), ("b", "gu", GOOD, 3.0), ("c", "gu", GOOD, 3.0)
    )
    for n, want in ((2, {"a", "b"}), (9, {"a", "b", "c"}), (0, {"a", "b", "c"}), (None, {"a", "b", "c"})):
        config = CurationConfig(languages=("gu",), max_samples=n)
        assert set(by_id(Curator(config).verdicts(clips))) == want


def pairwise(rows):
    """Reference answer: every pair of every clip."""
    out = {}
    for clip in {r[0] for r in rows}:
        spans = [(s, e) for c, s, e, _ in rows if c == clip]
        hit = any(
            a[0] < b[1] and b[0] < a[1]
            for i, a in enumerate(spans)
            for b in spans[i + 1 :]
        )
        out[clip] = (len({r[3] for r in rows if r[0] == clip}) <= 1, hit)
    return out


def profile(spark, rows, slice_us):
    df = spark.createDataFrame(rows, "clip_id string, start_us long, end_us long, speaker string")
    found = segments.overlap_profile(segments.diarization_rows(df), slice_us).collect()
    return {r.clip_id: (r.at_most_one_speaker, r.has_overlap) for r in found}


@pytest.mark.parametrize("slice_us", [1, 7, 50, 1_000_000])
def test_overlap_equals_pairwise_rule(spark, slice_us):
    rng = random.Random(slice_us)
    rows = []
    for clip in range(400):
        for _ in range(rng.randint(1, 5)):
            start = rng.randint(0, 60)
            rows.append((f"c{clip}", start, start + rng.choice([0, 0, 1, 5, 12]), rng.choice("AAAB")))
    assert profile(spark, rows, slice_us) == pairwise(rows)


def test_touching_and_repeated_segments(spark):
    rows = [
        ("touch", 0, 5, "A"), ("touch", 5, 9, "A"),
        ("same", 0, 5, "A"), ("same", 0, 5, "A"),
        ("points", 3, 3, "A"), ("points", 3, 3, "A"),
        ("inside", 0, 9, "A"), ("inside", 4, 4, "A"),
        ("self", 0, 9, "A"), ("self", 8, 12, "A"),
    ]
    assert profile(spark, rows, 10) == pairwise(rows)


def test_failure_and_silence_differ(spark):
    rows = [
        ("silent", None, None, None, "ok"),
        ("failed", None, None, None, "error: x"),
        ("late_failure", 0, 5, "A", "ok"), ("late_failure", None, None, None, "failed"),
        ("reversed", 9, 3, "A", "ok"),
        ("half", 9, None, "A", "ok"),
        ("fine", 0, 5, "A", "ok"),
    ]
    diar = spark.createDataFrame(
        rows, "clip_id string, start_us long, end_us long, speaker string, status string"
    )
    got = {r.clip_id: r.single_speaker for r in segments.single_speaker(diar).collect()}
    assert got == {
        "silent": True, "failed": False, "late_failure": False, "reversed": False, "half": False,
        "fine": True,
    }


def test_hot_clip_is_split_over_slices(spark):
    """One clip has most of all segments; its longest overlap spans many slices."""
    rows = spark.range(20_000).select(
        F.lit("hot").alias("clip_id"), (F.col("id") * 10).alias("start_us"),
        (F.col("id") * 10 + 10).alias("end_us"), F.lit("A").alias("speaker"),
    )
    clean = segments.single_speaker(segments.diarization_rows(rows), slice_us=1000).first()
    assert clean.single_speaker
    far = spark.createDataFrame([("hot", 5, 150_000, "A")], rows.schema)
    bad = segments.single_speaker(segments.diarization_rows(rows.union(far)), slice_us=1000).first()
    assert not bad.single_speaker


def test_clip_without_diarization_row_is_kept(make_clips, spark):
    clips = make_clips(("a", "gu", GOOD, 3.0))
    diar = spark.createDataFrame(
        [("other", 0, 1, "A", "ok")],
        "clip_id string, start_us long, end_us long, speaker string, status string",
    )
    assert by_id(Curator().verdicts(clips, diar)) == {"a": "kept"}


def test_speaker_counts(spark):
    rows = [("a", "A"), ("a", "A"), ("a", "B"), ("b", "A")]
    df = spark.createDataFrame(rows, "clip_id string, speaker string")
    assert {r.clip_id: r.speakers for r in segments.speaker_counts(df).collect()} == {"a": 2, "b": 1}


def many_clips(make_clips, n=60):
    rng = random.Random(4)
    return make_clips(
        *[
            (f"c{rng.randint(0, n)}", rng.choice(["gu", "hi"]), "x" * rng.randint(0, 90), rng.randint(1, 25))
            for _ in range(n)
        ]
    )


def ledger_state(df):
    return sorted((r.language, r.id, r.verdict, r.src_row) for r in df.collect())


def test_run_in_one_equals_run_in_parts(make_clips, tmp_path):
    clips = many_clips(make_clips)
    one = Curator().run_and_record(clips, str(tmp_path / "one"))
    for low, high in ((0, 20), (0, 45), (0, 60)):
        part = clips.where(F.col("src_row").between(low, high - 1))
        last = Curator(CurationConfig(run_id=str(high))).run_and_record(part, str(tmp_path / "parts"))
    assert ledger_state(one.verdicts) == ledger_state(last.verdicts)
    assert one.funnel.first().kept == last.funnel.first().kept
    again = Curator().run_and_record(clips, str(tmp_path / "parts"))
    assert ledger_state(again.verdicts) == ledger_state(one.verdicts)


def test_small_batch_anti_join_equals_plain(make_clips, monkeypatch):
    clips = many_clips(make_clips)
    done = clips.where("src_row % 3 = 0")
    want = sorted(r.src_row for r in resume.not_processed(clips, done).collect())
    assert sorted(r.src_row for r in resume.not_processed_small(clips, done).collect()) == want
    monkeypatch.setattr(resume, "IDS_TO_BROADCAST", 3)
    assert sorted(r.src_row for r in resume.not_processed_small(clips, done).collect()) == want


def test_stream_over_a_growing_folder(make_clips, spark, tmp_path):
    clips = many_clips(make_clips)
    folder, ledger = str(tmp_path / "in"), str(tmp_path / "ledger")

    def run():
        stream = spark.readStream.schema(clips.schema).parquet(folder)
        curate_stream(stream, ledger, str(tmp_path / "progress")).awaitTermination()
        return ledger_state(read_stream_ledger(spark, ledger))

    clips.where("src_row < 25").write.mode("append").parquet(folder)
    first = run()
    assert run() == first
    clips.where("src_row >= 25").write.mode("append").parquet(folder)
    assert run() == ledger_state(Curator().verdicts(clips))


def test_a_batch_that_runs_again_records_once(make_clips, spark, tmp_path):
    """A crash after the write but before the commit: the progress log is lost, the ledger is not."""
    clips = many_clips(make_clips)
    folder, ledger = str(tmp_path / "in"), str(tmp_path / "ledger")
    clips.write.parquet(folder)
    for progress in ("one", "two"):
        stream = spark.readStream.schema(clips.schema).parquet(folder)
        curate_stream(stream, ledger, str(tmp_path / progress)).awaitTermination()
    assert ledger_state(read_stream_ledger(spark, ledger)) == ledger_state(Curator().verdicts(clips))


def test_completeness_is_per_language(make_clips):
    ledger = make_clips(("a", "gu", GOOD, 3.0))
    assert resume.is_complete(ledger, "gu") and not resume.is_complete(ledger, "hi")


def test_keep_first_with_a_hot_id(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("gu").alias("language"), F.lit("f").alias("src_file"), (30_000 - F.col("id")).alias("src_row"),
    )
    firsts = dedup.keep_first(rows)
    assert firsts.count() == 20_001
    hot = firsts.where("id = 'hot'").first()
    assert hot.copies == 10_000 and hot.src_row == 3


def test_manifest_union_and_defaults(make_clips):
    rows = Curator().run(make_clips(("a", "gu", GOOD, 3.0), ("b", "hi", GOOD, 3.0))).kept
    both = pack.with_defaults(
        pack.all_manifests(
            rows.where("language = 'gu'"), rows.where("language = 'hi'").drop("cps", "speaker")
        )
    )
    got = {r.id: (r.speaker, r.cps) for r in both.collect()}
    assert got == {"a": ("spk_hf_gu", 10.0), "b": ("spk_hf_hi", 0.0)}


def test_missing_files_are_dropped_and_counted(make_clips):
    rows = Curator().run(make_clips(("a", "gu", GOOD, 3.0), ("b", "gu", GOOD, 3.0))).kept
    listing = rows.where("id = 'a'").select(wav_path(F.col("id")).alias("wav_path"))
    assert [r.id for r in pack.with_wav_present(rows, listing).collect()] == ["a"]
    assert pack.missing_wavs(rows, listing).collect() == [("gu", 1)]


def test_reference_candidates_both_ways(make_clips, monkeypatch):
    clips = make_clips(*[(f"c{i:02d}", "gu" if i % 2 else "hi", "x" * 80, 6.5 + i / 10) for i in range(40)])
    kept = Curator().run(clips).kept
    small = candidates.reference_candidates(kept, 3).select("language", "id", "rank").collect()
    monkeypatch.setattr("clipcurate.operators.ordering.TOP_K_IN_MEMORY", 1)
    large = candidates.reference_candidates(kept, 3).select("language", "id", "rank").collect()
    assert sorted(small) == sorted(large) and len(small) == 6
    assert {r.id for r in small if r["rank"] == 1} == {"c20", "c19"}


def test_profile_and_rate(make_clips):
    rows = Curator().verdicts(make_clips(("a", "gu", GOOD, 3.0), ("b", "gu", GOOD, 1.0)))
    counts = funnel.with_rejection_rate(funnel.funnel_by_language(rows)).first()
    assert counts.rejection_rate == 0.5
    profile = funnel.corpus_profile(rows).first()
    assert (profile.clips, profile.duration_ms, profile.optimizer_steps) == (2, 4000, 10)
    assert profile.hours == 4000 / 3_600_000
