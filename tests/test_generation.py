import json
from pathlib import Path

import pytest

from clipcurate.operators.segments import single_speaker
from clipcurate.plans import generate as plans
from clipcurate.plans.hooks import diarize, generate
from clipcurate.schemas import AUDIO
from clipcurate.sinks.tables import write_generation_log


@pytest.fixture
def plan(spark):
    texts = spark.createDataFrame([(10 * i, "t" * i) for i in range(1, 7)], "pos int, text string")
    refs = spark.createDataFrame([("v1", "v/v1.wav"), ("v2", "v/v2.mp3")], "ref_name string, ref_path string")
    return plans.generation_plan(texts, refs, plans.presets(spark, plans.PRESETS[:3]), "pos")


@pytest.fixture
def make_synthesizer():
    def make():
        def speak(text, ref, exaggeration, cfg_weight, file):
            if len(text) == 3:
                raise RuntimeError("no voice")
            return len(text) * 1234, 1000

        return speak

    return make


def test_plan_is_the_full_product(plan):
    rows = plan.collect()
    assert len(rows) == 6 * 2 * 3
    assert {(r.sample_no, r.text) for r in rows} == {(i, "t" * i) for i in range(1, 7)}
    own = {"v1_sample_002.wav", "v2_sample_002.wav"}
    folders = ("stable/", "", "expressive/")
    assert {r.file for r in rows if r.sample_no == 2} == {folder + file for folder in folders for file in own}
    assert len({r.file for r in rows}) == len(rows)


def test_a_further_preset_renames_nothing(spark):
    texts = spark.createDataFrame([(1, "a"), (2, "b")], "pos int, text string")
    refs = spark.createDataFrame([("v1", "v/v1.wav")], "ref_name string, ref_path string")
    files = []
    for settings in (plans.PRESETS[1:2], plans.PRESETS[:2], plans.PRESETS):
        rows = plans.generation_plan(texts, refs, plans.presets(spark, settings), "pos").collect()
        files.append({(r.preset, r.sample_no): r.file for r in rows})
    assert all(files[2][key] == file for few in files for key, file in few.items())


def test_one_failing_row_does_not_stop_the_rest(plan, make_synthesizer):
    log = generate(plan, make_synthesizer)
    rows = log.collect()
    assert len(rows) == plan.count()
    bad = [r for r in rows if r.sample_no == 3]
    assert all(r.file is None and r.duration == 0.0 and r.status == "error: no voice" for r in bad)
    good = {r.duration for r in rows if r.sample_no == 2}
    assert good == {round(2468 / 1000, 2)}
    summary = {r.ref_name: r for r in plans.generation_summary(log).collect()}
    assert (summary["v1"].succeeded, summary["v1"].attempted) == (15, 18)
    want = sum(round(n * 1.234, 2) for n in (1, 2, 4, 5, 6)) * 3
    assert abs(summary["v1"].total_seconds - want) < 1e-9


def test_model_is_built_once_per_task(spark, plan, tmp_path):
    folder = str(tmp_path)

    def make():
        import os
        import uuid

        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        return lambda *a: (1, 1)

    generate(plan, make, tasks=3).collect()
    assert 1 <= len(list(tmp_path.iterdir())) <= 3


def test_log_is_json_with_nulls_and_plain_unicode(spark, tmp_path):
    rows = [("v", "p", 1, "કેમ", None, 0.0, "error: x")]
    log = spark.createDataFrame(
        rows, "ref_name string, preset string, sample_no long, text string, file string, duration double, status string"
    )
    write_generation_log(log, str(tmp_path / "log"))
    (file,) = Path(tmp_path, "log", "ref_name=v").glob("*.json")
    line = file.read_text("utf-8")
    assert "ક" in line
    assert json.loads(line)["file"] is None


def test_diarizer_failures_and_silence(spark):
    def make():
        def listen(data, rate):
            if data == b"boom":
                raise RuntimeError("no model")
            if data == b"quiet":
                return []
            return [(0.0, 1.5, "A"), (1.5, 2.0, "A" if data == b"one" else "B")]

        return listen

    clips = spark.createDataFrame(
        [(n, (n.encode(), 8)) for n in ("one", "two", "quiet", "boom")], f"id string, audio {AUDIO.simpleString()}"
    )
    rows = diarize(clips, make)
    got = {r.clip_id: r.single_speaker for r in single_speaker(rows).collect()}
    assert got == {"one": True, "two": False, "quiet": True, "boom": False}
    one = sorted((r.start_us, r.end_us, r.status) for r in rows.where("clip_id = 'one'").collect())
    assert one == [(0, 1_500_000, "ok"), (1_500_000, 2_000_000, "ok")]
