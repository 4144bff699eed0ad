"""Physical plans: what is read, what is shuffled and what is never done."""

import pytest
from pyspark.sql import functions as F

from clipcurate.config import CurationConfig
from clipcurate.operators.ordering import top_per_group
from clipcurate.plans.curate import Curator
from clipcurate.session import build_session, scratch_root
from clipcurate.sources import clips as clip_source

DATA = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "clips")
    rows = spark.range(50).select(
        F.col("id").cast("string"),
        F.struct(F.lit(b"x").alias("bytes"), F.lit(8).alias("sampling_rate")).alias("audio"),
        F.lit("some text here").alias("text"), F.when(F.col("id") % 2 == 0, "gu").otherwise("hi").alias("language"),
    )
    rows.write.parquet(path)
    return path


def narrow(clips):
    return clips.select(
        "id", "language", "text", F.lit(80).cast("long").alias("frames"),
        F.lit(20).alias("sampling_rate"), "src_file", "src_row",
    )


def test_language_reaches_the_scan_and_audio_does_not(spark, stored):
    clips = narrow(clip_source.read_raw(spark, stored))
    plan = plan_of(Curator(CurationConfig(languages=("gu",))).verdicts(clips))
    assert "EqualTo(language,gu)" in plan
    assert "audio" not in plan.split("ReadSchema:")[1].splitlines()[0]


def test_skipping_diarization_plans_no_join(spark, stored):
    clips = narrow(clip_source.read_raw(spark, stored))
    plan = plan_of(Curator().verdicts(clips))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_one_language_shuffles_its_clips_once(spark, stored):
    clips = narrow(clip_source.read_raw(spark, stored))
    diar = spark.createDataFrame(
        [("1", 0, 1, "A", "ok")],
        "clip_id string, start_us long, end_us long, speaker string, status string",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        curator = Curator(CurationConfig(languages=("gu",)))
        plan = plan_of(curator.verdicts(clips, diar, clips.where("src_row < 5")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2
    # one exchange for the clips, one for the ledger, three for the segments
    assert plan.count("Exchange hashpartitioning") == 5


def test_first_copies_are_folded_before_the_shuffle(spark, stored):
    plan = plan_of(Curator().verdicts(narrow(clip_source.read_raw(spark, stored))))
    assert "partial_min_by" in plan.split("Exchange hashpartitioning")[1]


def test_small_top_k_is_cut_before_the_shuffle(spark, stored):
    clips = narrow(clip_source.read_raw(spark, stored))
    plan = plan_of(top_per_group(clips, "language", 3, "id"))
    assert "WindowGroupLimit" in plan.split("Exchange")[1]


def test_no_query_plans_a_cross_join(spark):
    from __spark_entry__ import queries

    # Queries that run jobs of their own while they are built are covered by the registry test.
    lazy = [
        "q_curate", "q_verdict", "q_funnel", "q_keep_first", "q_resume", "q_segment_overlap", "q_gen_presets",
        "q_vocab_extend", "q_vocab_vectors", "q_char_encode", "q_mean_vector", "q_reference_candidates",
    ]
    for name in lazy:
        plan = plan_of(queries()[name](spark, DATA))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
        assert "LocalTableScan" not in plan or name in ("q_vocab_extend", "q_vocab_vectors", "q_gen_presets"), name


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert build_session() is not None


def test_scratch_tables_can_be_released(spark, monkeypatch, tmp_path):
    from pathlib import Path

    from clipcurate import session

    monkeypatch.setattr(session, "_scratch", [])
    assert session.written(spark.range(5), "few").count() == 5
    (path,) = session._scratch
    assert Path(path).exists()
    session.release_scratch(spark)
    assert not Path(path).exists() and session._scratch == []


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    from types import SimpleNamespace

    from clipcurate import session

    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None, applicationId="x")
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(ValueError):
        session.scratch_root(cluster)
