"""Units of work that survive what kills a run."""

import os

import pytest
from pyspark.sql import functions as F

from clipcurate.plans import progress as progress_module
from clipcurate.plans.hooks import CRASHED, diarize_in_units, generate_in_units
from clipcurate.plans.progress import Progress, source_unit
from clipcurate.schemas import AUDIO, RAW_CLIP


@pytest.fixture
def clips(spark, tmp_path):
    rows = [(f"c{i:02d}", (bytes([i]), 8), "t", "gu") for i in range(24)]
    path = str(tmp_path / "raw")
    spark.createDataFrame(rows, RAW_CLIP).write.parquet(path)
    from clipcurate.sources.clips import read_raw

    placed = read_raw(spark, path)
    return placed.select("id", "language", "audio", "src_file", "src_row")


def wanted_of(clips):
    number = F.substring("id", 2, 2).cast("int")
    unit = F.call_function("div", number.cast("long"), F.lit(4).cast("long")).cast("string")
    return clips.select("language", "id", "src_file", "src_row", unit.alias("unit"))


def listener(folder, bad=(), kill=False):
    """Notes every clip it hears; dies on bad ones, once the mark is there or always."""

    def make():
        def listen(data, rate):
            with open(os.path.join(folder, f"heard-{data[0]}"), "a") as f:
                f.write("x")
            if data[0] in bad:
                if kill:
                    os._exit(9)
                raise SystemExit("the worker goes down")
            return [(0.0, 1.0, "A")]

        return listen

    return make


def heard(folder):
    return {int(f.split("-")[1]): os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder)}


def test_a_clip_that_kills_its_worker_is_given_up_and_others_are_heard(spark, clips, tmp_path):
    notes, folder = tmp_path / "notes", str(tmp_path / "progress")
    notes.mkdir()
    make = listener(str(notes), bad=(13,), kill=True)
    rows = diarize_in_units(clips, wanted_of(clips), make, folder, wave_units=2).collect()
    assert sorted(r.clip_id for r in rows) == [f"c{i:02d}" for i in range(24)]
    assert [(r.clip_id, r.language) for r in rows if r.status == CRASHED] == [("c13", "gu")]
    before = heard(notes)
    # Only what shared a wave with the bad clip was heard more than once.
    assert all(n == 1 for i, n in before.items() if i < 8 or i >= 16)
    again = diarize_in_units(clips, wanted_of(clips), make, folder).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    assert heard(notes) == before


def test_a_driver_that_dies_leaves_finished_waves(spark, clips, tmp_path, monkeypatch):
    notes, folder = tmp_path / "notes", str(tmp_path / "progress")
    notes.mkdir()
    make = listener(str(notes))
    real = Progress.attempt
    calls = []

    def dies(self, keys, units, work):
        calls.append(units)
        if len(calls) == 3:  # after its rows are written, before its commit
            self._record("cut-off", progress_module.INTENT, units)
            work(keys).write.parquet(f"{self.folder}/results/wave=cut-off")
            raise KeyboardInterrupt
        return real(self, keys, units, work)

    monkeypatch.setattr(Progress, "attempt", dies)
    with pytest.raises(KeyboardInterrupt):
        diarize_in_units(clips, wanted_of(clips), make, folder, wave_units=2)
    monkeypatch.setattr(Progress, "attempt", real)
    first = heard(notes)
    assert Progress(spark, folder).in_flight() == set(calls[2])
    rows = diarize_in_units(clips, wanted_of(clips), make, folder, wave_units=2).collect()
    assert sorted(r.clip_id for r in rows) == [f"c{i:02d}" for i in range(24)]
    after = heard(notes)
    assert {i for i in first if after[i] > first[i]} == set(range(16, 24))


def test_new_clips_of_a_known_unit_are_heard_and_old_ones_not(spark, clips, tmp_path):
    notes, folder = tmp_path / "notes", str(tmp_path / "progress")
    notes.mkdir()
    make = listener(str(notes))
    wanted = wanted_of(clips)
    diarize_in_units(clips, wanted.where("id < 'c10'"), make, folder)
    assert set(heard(notes)) == set(range(10))
    assert diarize_in_units(clips, wanted, make, folder).count() == 24
    assert set(heard(notes).values()) == {1} and len(heard(notes)) == 24


def test_a_model_that_cannot_be_built_is_an_error(spark, clips, tmp_path):
    def make():
        raise ImportError("no such model")

    with pytest.raises(Exception, match="no such model"):
        diarize_in_units(clips, wanted_of(clips), make, str(tmp_path / "progress"))


def test_units_and_empty_input(spark, clips, tmp_path):
    units = spark.createDataFrame([("f", 0), ("f", 1999), ("f", 2000), (None, None)], "src_file string, src_row long")
    assert [r[0] for r in units.select(source_unit()).collect()] == ["f#0", "f#0", "f#1", "#-1"]
    empty = clips.limit(0)
    assert diarize_in_units(empty, wanted_of(empty), listener(""), str(tmp_path / "p")).count() == 0


def test_a_model_that_fails_for_every_key_of_one_unit_is_an_error(spark, clips, tmp_path):
    def make():
        raise ImportError("no such model")

    folder = str(tmp_path / "progress")
    one_unit = wanted_of(clips).where("id < 'c04'")
    with pytest.raises(Exception, match="no such model"):
        diarize_in_units(clips, one_unit, make, folder)
    notes = tmp_path / "notes"
    notes.mkdir()
    rows = diarize_in_units(clips, one_unit, listener(str(notes)), folder).collect()
    assert [r.status for r in rows] == ["ok"] * 4


def plan_of(spark, number, text="t"):
    rows = [("v", "/v.wav", "stable", 0.3, 0.3, i, f"{text}{i}", f"v_{i}.wav") for i in range(number)]
    names = "ref_name string, ref_path string, preset string, exaggeration double, cfg_weight double, sample_no long, text string, file string"
    return spark.createDataFrame(rows, names)


def speaker(folder, bad=()):
    def make():
        def speak(text, ref, exaggeration, cfg_weight, file):
            with open(os.path.join(folder, f"said-{text[1:]}"), "a") as f:
                f.write("x")
            if text in bad:
                os._exit(9)
            return 150, 100

        return speak

    return make


def test_one_text_in_a_thousand_that_kills_its_worker_costs_one_result(spark, tmp_path):
    notes, folder = tmp_path / "notes", str(tmp_path / "progress")
    notes.mkdir()
    plan = plan_of(spark, 1000)
    rows = generate_in_units(plan, speaker(str(notes), bad=("t637",)), folder, tasks=2).collect()
    assert sorted(r.sample_no for r in rows) == list(range(1000))
    assert [(r.text, r.file, r.duration, r.status) for r in rows if r.status != "ok"] == [("t637", None, 0.0, CRASHED)]
    said = heard(notes)
    again = generate_in_units(plan, speaker(str(notes)), folder, tasks=2).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows)) and heard(notes) == said


def test_speech_goes_on_and_a_changed_text_is_spoken_anew(spark, tmp_path):
    notes, folder = tmp_path / "notes", str(tmp_path / "progress")
    notes.mkdir()
    plan = plan_of(spark, 12)
    generate_in_units(plan, speaker(str(notes)), folder, unit_samples=2, wave_units=2, most_waves=1, tasks=1)
    assert len(heard(notes)) == 4
    changed = plan.withColumn("text", F.expr("if(sample_no = 1, 'u99', text)"))
    rows = generate_in_units(changed.union(changed.limit(3)), speaker(str(notes)), folder, unit_samples=2, tasks=1).collect()
    assert sorted(r.sample_no for r in rows) == list(range(12))
    assert {r.text for r in rows if r.sample_no == 1} == {"u99"}
    assert set(heard(notes).values()) == {1} and set(heard(notes)) == {*range(12), 99}
    assert generate_in_units(plan.limit(0), speaker(str(notes)), str(tmp_path / "none")).count() == 0


def test_waves_grow_with_the_units_and_shrink_where_they_fail(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(progress_module, "CALL_WAVES", 2)
    monkeypatch.setattr(progress_module, "WAVE_UNITS", 4)
    real, calls = Progress.attempt, []
    monkeypatch.setattr(Progress, "attempt", lambda self, keys, units, work: calls.append(len(units)) or real(self, keys, units, work))
    notes, folder = tmp_path / "notes", str(tmp_path / "progress")
    notes.mkdir()
    plan = plan_of(spark, 20)
    rows = generate_in_units(plan, speaker(str(notes), bad=("t3",)), folder, unit_samples=1, wave_units=1, tasks=1).collect()
    assert [r.text for r in rows if r.status == CRASHED] == ["t3"] and len(rows) == 20
    # A wave of ten is cut into threes, the failed three into units; the unit is halved to its key and given up.
    assert calls == [10, 3, 3, 3, 1, 1, 1, 1, 1, 1, 10]
    assert all(n == 1 for i, n in heard(notes).items() if i >= 10)
