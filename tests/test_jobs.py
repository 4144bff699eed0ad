import io
import wave
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from clipcurate.config import CurationConfig
from clipcurate.plans import generate as generation
from clipcurate.plans import jobs, packing
from clipcurate.plans.curate import Curator
from clipcurate.plans.hooks import generate
from clipcurate.schemas import RAW_CLIP
from clipcurate.sources.ledger import read_ledger


def wav(seconds, mark):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(100)
        w.writeframes(bytes([mark, 0]) * round(seconds * 100))
    return out.getvalue()


@pytest.fixture
def raw(spark, tmp_path):
    good = "x" * 30
    rows = [
        (f"g{i}", (wav(3, i % 200), 100), good, "gu") for i in range(12)
    ] + [
        ("g0", (wav(4, 99), 100), good, "gu"),
        ("short", (wav(1, 1), 100), good, "gu"),
        ("broken", (b"zzz", 100), good, "gu"),
        ("empty", (wav(3, 1), 100), ">|", "gu"),
        ("h1", (wav(3, 1), 100), good, "hi"),
        ("h2", (wav(3, 255), 100), good, "hi"),
    ]
    path = str(tmp_path / "raw")
    spark.createDataFrame(rows, RAW_CLIP).coalesce(2).write.parquet(path)
    return path



@pytest.fixture
def listener():
    def make():
        def listen(data, rate):
            if data[44] == 255:
                raise RuntimeError("no model")
            return [(0.0, 1.0, "A"), (1.0, 2.0, "B" if data[44] == 5 else "A")]

        return listen

    return make


def test_curate_pack_and_fast_path(spark, raw, listener, tmp_path):
    out = str(tmp_path / "out")
    result = jobs.curate_raw(spark, raw, out, "gu", make_diarizer=listener)
    assert result.funnel.first().asDict() == {
        "total": 18, "lang_filtered": 16, "duplicates": 1, "text_rejected": 1, "decode_error": 1,
        "duration_rejected": 1, "cps_rejected": 0, "multi_speaker_rejected": 1, "kept": 11,
    }
    again = jobs.curate_raw(spark, raw, out, "gu", make_diarizer=listener)
    assert again.funnel.first() == result.funnel.first()
    hindi = jobs.curate_language(spark, raw, out, "hi", make_diarizer=listener)
    assert [r.id for r in hindi.collect()] == ["h1"]

    counts = jobs.pack_languages(spark, raw, out, ("gu", "hi"))
    assert {r.language: r.clips for r in counts.collect()} == {"gu": 11, "hi": 1, None: 12}
    packed = spark.read.parquet(f"{out}/data/train")
    rows = {r.id: r for r in packed.collect()}
    assert len(rows) == 12 and bytes(rows["g0"].audio.bytes) == wav(3, 0)
    assert rows["g0"].duration_sec == 3.0 and rows["g0"].cps == 10.0

    fast_out = str(tmp_path / "fast")
    fast = jobs.curate_language(spark, raw, fast_out, "hi", clean_path=f"{out}/data/train")
    assert [(r.id, r.duration_ms, r.speaker) for r in fast.collect()] == [("h1", 3000, "spk_hf_hi")]
    assert list(Path(fast_out, "hi").iterdir())
    assert not Path(fast_out, "ledger").exists()


def test_new_files_are_curated_as_in_one_run(spark, raw, tmp_path):
    folder = tmp_path / "arriving"
    folder.mkdir()
    want = jobs.curate_raw(spark, raw, str(tmp_path / "batch"), "gu").verdicts
    files = sorted(Path(raw).glob("*.parquet"))
    assert len(files) == 2
    for file in files:
        (folder / file.name).write_bytes(file.read_bytes())
        got = jobs.curate_new_files(
            spark, str(folder), str(tmp_path / "out"), str(tmp_path / "progress"),
            CurationConfig(languages=("gu",)),
        )
    assert sorted((r.id, r.verdict) for r in got.collect()) == sorted(
        (r.id, r.verdict) for r in want.collect()
    )


def test_without_diarizer_and_with_a_limit(spark, raw, tmp_path):
    config = CurationConfig(max_samples=3)
    result = jobs.curate_raw(spark, raw, str(tmp_path / "out"), "gu", config)
    row = result.funnel.first()
    assert (row.total, row.lang_filtered, row.multi_speaker_rejected) == (18, 3, 0)


def test_generate(spark, tmp_path):
    for name in ("v1.wav", "v2.flac", "note.txt"):
        (tmp_path / name).write_bytes(b"1")
    (tmp_path / "texts").write_text("one\n\n two \nthree\n", "utf-8")

    def make():
        def speak(text, ref, exaggeration, cfg_weight, file):
            if text == "two":
                raise RuntimeError("no")
            return 150, 100

        return speak

    summary = jobs.generate_speech(
        spark, str(tmp_path), str(tmp_path / "out"), make, texts_file=str(tmp_path / "texts")
    )
    got = {r.ref_name: (r.succeeded, r.attempted, r.total_seconds) for r in summary.collect()}
    assert got == {"v1": (2, 3, 3.0), "v2": (2, 3, 3.0)}
    listed = jobs.generate_speech(spark, str(tmp_path), str(tmp_path / "out2"), make, texts=["a"])
    assert {r.attempted for r in listed.collect()} == {1}


def test_partitioned_folders_keep_their_recordings(spark, tmp_path):
    good = "x" * 30
    rows = [(f"{lang}{i}", (wav(3, k * 50 + i), 100), good, lang) for k, lang in enumerate(("gu", "hi")) for i in range(6)]
    raw = str(tmp_path / "raw")
    spark.createDataFrame(rows, RAW_CLIP).coalesce(1).write.partitionBy("language").parquet(raw)
    out = str(tmp_path / "out")
    for lang in ("gu", "hi"):
        jobs.curate_raw(spark, raw, out, lang)
    assert {r.language: r.clips for r in jobs.pack_languages(spark, raw, out, ("gu", "hi")).collect()} == {
        "gu": 6, "hi": 6, None: 12,
    }
    packed = spark.read.parquet(f"{out}/data/train").collect()
    assert {r.id: bytes(r.audio.bytes) for r in packed} == {i: audio[0] for i, audio, _, _ in rows}
    assert len(packed) == 12


def test_clips_without_a_recording_leave_no_gap(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    jobs.curate_raw(spark, raw, out, "gu")
    fewer = str(tmp_path / "fewer")
    # The same files, with one clip under another id: its recording is no longer there.
    for file in sorted(Path(raw).glob("*.parquet")):
        table = pq.read_table(file)
        ids = pa.array(["other" if x == "g3" else x for x in table.column("id").to_pylist()])
        Path(fewer).mkdir(exist_ok=True)
        pq.write_table(table.set_column(table.schema.get_field_index("id"), "id", ids), f"{fewer}/{file.name}")
    counts = {r.language: r.clips for r in jobs.pack_languages(spark, fewer, out, ("gu",)).collect()}
    assert counts == {"gu": 11, None: 11}
    assert [r.id for r in spark.read.parquet(f"{out}/missing").collect()] == ["g3"]


def verdict_rows(ledger):
    return sorted((r.language, r.id, r.verdict, r.copies, r.src_file, r.src_row) for r in ledger.collect())


@pytest.mark.parametrize("order", ["stream first", "batch first"])
def test_batch_and_stream_share_a_ledger(spark, raw, tmp_path, order):
    config = CurationConfig(languages=("gu",))
    whole = jobs.curate_raw(spark, raw, str(tmp_path / "whole"), "gu").verdicts
    first, out = tmp_path / "first", str(tmp_path / "out")
    first.mkdir()
    files = sorted(Path(raw).glob("*.parquet"))
    (first / files[0].name).write_bytes(files[0].read_bytes())
    if order == "stream first":
        jobs.curate_new_files(spark, str(first), out, str(tmp_path / "progress"), config)
        jobs.curate_raw(spark, raw, out, "gu")
    else:
        jobs.curate_raw(spark, str(first), out, "gu")
        jobs.curate_new_files(spark, raw, out, str(tmp_path / "progress"), config)
    got = read_ledger(spark, f"{out}/ledger")
    assert [r[:3] for r in verdict_rows(got)] == [r[:3] for r in verdict_rows(whole)]
    again = jobs.curate_raw(spark, raw, out, "gu").verdicts
    assert verdict_rows(again) == verdict_rows(got)


def test_languages_side_by_side(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda lang: jobs.curate_raw(spark, raw, out, lang), ("gu", "hi")))
    apart = [verdict_rows(jobs.curate_raw(spark, raw, str(tmp_path / x), x).verdicts) for x in ("gu", "hi")]
    assert verdict_rows(read_ledger(spark, f"{out}/ledger")) == sorted(apart[0] + apart[1])


def test_a_stream_refuses_a_limit(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="max_samples"):
        jobs.curate_new_files(spark, raw, str(tmp_path / "o"), str(tmp_path / "p"), CurationConfig(max_samples=2))


def test_speakers_of_one_language_do_not_reject_another(spark, make_clips):
    clips = make_clips(("a", "gu", "x" * 30, 3.0), ("a", "hi", "x" * 30, 3.0))
    spoken = spark.createDataFrame(
        [("gu", "a", 0, 10, "A", "ok"), ("gu", "a", 10, 20, "B", "ok"), ("hi", "a", 5, 15, "A", "ok")],
        "language string, clip_id string, start_us long, end_us long, speaker string, status string",
    )
    for languages in (None, ("gu", "hi"), ("hi",)):
        rows = Curator(CurationConfig(languages=languages)).verdicts(clips, spoken).collect()
        got = {r.language: r.verdict for r in rows}
        assert got.get("gu", "multi_speaker_rejected") == "multi_speaker_rejected" and got["hi"] == "kept"


def test_several_settings_write_different_files(spark):
    texts = spark.createDataFrame([("one", 1), ("two", 2)], "text string, n int")
    voices = spark.createDataFrame([("v", "/v.wav")], "ref_name string, ref_path string")
    plan = generation.generation_plan(texts, voices, generation.presets(spark, generation.PRESETS), "n")
    files = [r.file for r in plan.collect()]
    assert len(set(files)) == len(files) == 8 and "stable/v_sample_001.wav" in files


def test_a_model_is_spread_over_tasks(spark):
    texts = spark.createDataFrame([(f"t{i}", i) for i in range(64)], "text string, n int")
    voices = spark.createDataFrame([("v", "/v.wav")], "ref_name string, ref_path string")
    plan = generation.generation_plan(texts, voices, generation.presets(spark), "n")
    log = generate(plan, lambda: lambda *_: (100, 100), tasks=8)
    assert log.withColumn("p", F.spark_partition_id()).select("p").distinct().count() > 4


@pytest.mark.parametrize("sent", [True, False])
def test_every_path_of_a_manifest_exists(spark, raw, tmp_path, monkeypatch, sent):
    if not sent:
        monkeypatch.setattr(packing, "PLACE_BYTES_TO_BROADCAST", 0)
    out = str(tmp_path / "out")
    kept = jobs.curate_language(spark, raw, out, "gu", export=True)
    listed = [line.split()[1] for p in sorted(Path(out, "gu", "wav.scp").glob("part-*")) for line in p.read_text().splitlines()]
    assert len(listed) == kept.count() == 12 and all(Path(path).is_file() for path in listed)
    assert len(list(Path(out, "gu", "wavs").iterdir())) == 12
    assert Path(out, "gu", "wavs", "g3.wav").read_bytes() == wav(3, 3)
    # A file that was lost comes back, the others are not written again.
    times = {p.name: p.stat().st_mtime_ns for p in Path(out, "gu", "wavs").iterdir()}
    Path(out, "gu", "wavs", "g3.wav").unlink()
    assert jobs.export_language(spark, raw, out, "gu").count() == 12
    again = {p.name: p.stat().st_mtime_ns for p in Path(out, "gu", "wavs").iterdir()}
    assert {n for n in again if again[n] != times[n]} == {"g3.wav"}


def test_a_clip_that_cannot_be_a_file_is_in_no_manifest(spark, tmp_path):
    rows = [("a/b", (wav(3, 1), 100), "x" * 30, "gu"), ("c", (wav(3, 2), 100), "x" * 30, "gu")]
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    spark.createDataFrame(rows, RAW_CLIP).write.parquet(raw)
    assert [r.id for r in jobs.curate_language(spark, raw, out, "gu", export=True).collect()] == ["c"]
    assert [tuple(r) for r in spark.read.parquet(f"{out}/gu/wav_errors").select("id", "status").collect()] == [("a/b", "bad id")]
    jobs.pack_languages(spark, raw, out, ("gu",))
    clean = jobs.curate_language(spark, raw, str(tmp_path / "fast"), "gu", clean_path=f"{out}/data/train", export=True)
    assert [r.id for r in clean.collect()] == ["c"]
    assert Path(tmp_path, "fast", "gu", "wavs", "c.wav").read_bytes() == wav(3, 2)
