"""Packing that goes on: full shards stay byte for byte, and a call that was cut off leaves nothing behind."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clipcurate.plans import packing
from clipcurate.plans.curate import Curator
from clipcurate.schemas import CLEAN_CLIP
from clipcurate.session import written
from clipcurate.sinks import tables


@pytest.fixture
def clips(make_clips):
    """Kept rows and audio of clips by number, each delivered twice; audio says which copy it is."""

    def make(numbers):
        rows = make_clips(*[(f"{i:03d}", "hi" if i % 2 else "gu", "x" * 30, 2.5) for i in numbers])
        rows = rows.withColumn("src_row", F.col("id").cast("long"))
        again = rows.withColumn("src_row", F.col("src_row") + 1000)
        data = F.encode(F.concat_ws(":", "id", "src_row"), "UTF-8")
        both = rows.union(again)
        audio = both.select(*packing.PLACE, F.struct(data.alias("bytes"), "sampling_rate").alias("audio"))
        return written(Curator().run(both).kept, "test-kept"), audio

    return make


def files(out):
    found = sorted(Path(out, "data/train").rglob("*.parquet"))
    return {f.parent.name: f.read_bytes() for f in found}


def rows(spark, out):
    return {r.id: (r.shard, bytes(r.audio.bytes).decode()) for r in spark.read.parquet(f"{out}/data/train").collect()}


def sizes(spark, out):
    counted = spark.read.parquet(f"{out}/data/train").groupBy("shard").count()
    return [r["count"] for r in counted.orderBy("shard").collect()]


@pytest.mark.parametrize("sent", [True, False])
def test_full_shards_stay_and_the_last_is_filled(spark, clips, tmp_path, monkeypatch, sent):
    if not sent:
        monkeypatch.setattr(packing, "LIMITS_TO_BROADCAST", 0)
    out = str(tmp_path)
    assert packing.append_clips(*clips(range(0, 140, 2)), out, 30) == packing.Packed(1, 70)
    first, before = files(out), rows(spark, out)
    assert sizes(spark, out) == [30, 30, 10]
    assert packing.append_clips(*clips(range(115)), out, 30) == packing.Packed(2, 127)
    second, after = files(out), rows(spark, out)
    assert sizes(spark, out) == [30, 30, 30, 30, 7]
    assert all(first[s] == second[s] for s in ("shard=shard_00000", "shard=shard_00001"))
    assert all(after[i] == place for i, place in before.items())
    assert {i for i in after} == {f"{i:03d}" for i in {*range(0, 140, 2), *range(115)}}
    assert all(data == f"{i}:{int(i)}" for i, (_, data) in after.items())
    assert len(second) == 5
    # Nothing new: nothing is written.
    assert packing.append_clips(*clips(range(115)), out, 30) == packing.Packed(2, 127)
    assert files(out) == second


def test_filled_shards_keep_old_rows_first_and_their_values(spark, clips, tmp_path):
    out = str(tmp_path)
    packing.append_clips(*clips([5, 7]), out, 30)
    old = {r.id: r for r in spark.read.parquet(f"{out}/data/train").collect()}
    packing.append_clips(*clips(range(8)), out, 30)
    read = spark.read.parquet(f"{out}/data/train").select("*", "_metadata.row_index").orderBy("row_index").collect()
    assert [r.id for r in read] == ["005", "007", "000", "002", "004", "006", "001", "003"]
    for r in read[:2]:
        assert r.asDict() == {**old[r.id].asDict(), "row_index": r.row_index}


def test_a_call_that_was_cut_off_is_undone(spark, clips, tmp_path, monkeypatch):
    out = str(tmp_path)
    packing.append_clips(*clips(range(0, 140, 2)), out, 30)
    want = rows(spark, out)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(packing, "_commit", die)
        with pytest.raises(KeyboardInterrupt):
            packing.append_clips(*clips(range(140)), out, 30)
    assert len(files(out)) == 5
    # The new clips are gone again when the next call comes: their rows have to go as well.
    packing.append_clips(*clips(range(0, 140, 2)), out, 30)
    assert rows(spark, out) == want and len(files(out)) == 3
    packing.append_clips(*clips(range(140)), out, 30)
    once = str(tmp_path / "once")
    packing.append_clips(*clips(range(0, 140, 2)), once, 30)
    packing.append_clips(*clips(range(140)), once, 30)
    assert rows(spark, out) == rows(spark, once)


def test_a_lost_recording_is_an_error_before_the_commit(spark, clips, tmp_path):
    kept, audio = clips(range(10))
    with pytest.raises(RuntimeError, match="9 clips instead of 10"):
        packing.append_clips(kept, audio.where("id <> '003'"), str(tmp_path), 30)
    assert packing.packed_so_far(spark, str(tmp_path)) == packing.Packed(0, 0, 1)
    assert packing.append_clips(kept, audio, str(tmp_path), 30) == packing.Packed(1, 10)


def test_nothing_kept(spark, clips, tmp_path):
    kept, audio = clips(range(3))
    assert packing.append_clips(kept.where("false"), audio, str(tmp_path)) == packing.Packed()
    assert packing.read_shards(spark, str(tmp_path), []).count() == 0


def test_audio_is_shuffled_once(spark, clips):
    kept, audio = clips(range(70))
    numbered = written(packing.pack.assign_shards(kept, 30), "numbered")
    audio = written(audio, "audio")
    tail = packing._as_clips(packing._tail(spark, "/nowhere", 0), 0)
    with packing._settings(spark, **packing.WRITE_SETTINGS):
        plan = packing.shard_rows_of(audio, numbered, tail, 3)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    exchanges = [line for line in initial.splitlines() if " Exchange " in line or "-Exchange" in line or "Exchange hash" in line]
    by_shard = [line for line in exchanges if "hashpartitioning(shard_id" in line]
    assert len(by_shard) == 2 and "ShuffledHashJoin" in initial and "SortMergeJoin" not in initial
    # One for the clips, one for their audio; the other one builds the table of limits.
    assert all("hashpartitioning(language" in line or line in by_shard for line in exchanges)


def test_shard_of_every_key(spark):
    """The search in blocks of limits against a plain comparison, with ids before the first limit and in other languages."""
    entries = [(lang, s, f"{k * 10:04d}") for lang in ("gu", "hi") for s, k in enumerate(range(1, 60))]
    limits = spark.createDataFrame(entries, "language string, shard_id long, first_id string")
    keys = [(lang, f"{i:04d}") for lang in ("gu", "hi") for i in range(0, 620, 7)]
    searched = spark.createDataFrame(keys, "language string, id string").join(
        packing._limit_lists(limits, limits.count()), "language"
    )
    for r in searched.select("language", "id", packing._shard_of(F.col("id")).alias("s")).collect():
        fits = [s for lang, s, first in entries if lang == r.language and first <= r.id]
        assert r.s == (max(fits) if fits else None)


def test_many_shards_are_listed_by_few_tasks(spark, tmp_path):
    rows = spark.range(80).selectExpr("cast(id as string) id", "'gu' language", "format_string('shard_%05d', id) shard")
    rows.coalesce(1).write.partitionBy("shard").parquet(str(tmp_path / tables.SHARD_FOLDER))
    context = spark.sparkContext
    context.setJobGroup("listing", "")
    try:
        found = packing.read_shards(spark, str(tmp_path), CLEAN_CLIP.fields[:1])
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    status = context.statusTracker()
    stages = [i for job in status.getJobIdsForGroup("listing") for i in status.getJobInfo(job).stageIds]
    assert stages and all(status.getStageInfo(i).numTasks < 80 for i in stages)
    assert found.where("shard_no >= 78").count() == 2 and found.count() == 80
