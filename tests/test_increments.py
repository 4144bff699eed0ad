"""Late copies, counts by increments, buckets and compaction."""

import os
import re
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clipcurate.config import CurationConfig
from clipcurate.operators.funnel import funnel_by_language, funnel_of_counts
from clipcurate.plans import increments
from clipcurate.plans.curate import Curator
from clipcurate.plans.increments import compact_ledger, read_counts
from clipcurate.schemas import BUCKETS
from clipcurate.session import settings
from clipcurate.sources.ledger import bucket_of, import_ledger, read_ledger
from clipcurate.sinks.tables import append_ledger
from clipcurate.streaming.curate import curate_stream

TEXT = "x" * 30


@pytest.fixture
def clips(make_clips):
    rows = [(f"c{i % 17}", "gu" if i % 3 else "hi", TEXT if i % 5 else "", 3 if i % 7 else 30) for i in range(60)]
    return make_clips(*rows)


def funnel_rows(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def record(clips, path, run_id, **config):
    return Curator(CurationConfig(run_id=run_id, **config)).run_and_record(clips, path)


def state(df):
    return sorted((r.language, r.id, r.verdict, r.src_row) for r in df.collect())


def test_three_copies_in_two_runs_count_as_in_one(make_clips, spark, tmp_path):
    rows = make_clips(*[("a", "gu", TEXT, 3)] * 3)
    record(rows.where("src_row < 1"), str(tmp_path / "l"), "one")
    row = record(rows, str(tmp_path / "l"), "two").funnel.first()
    assert (row.lang_filtered, row.duplicates, row.kept) == (3, 2, 1)
    again = record(rows, str(tmp_path / "l"), "three").funnel.first()
    assert (again.lang_filtered, again.duplicates, again.kept) == (3, 2, 1)


def test_resumed_funnel_equals_that_of_one_run(clips, spark, tmp_path):
    path = str(tmp_path / "ledger")
    want = funnel_rows(funnel_by_language(Curator().verdicts(clips)))
    for stop in (10, 30, 31, 60):
        record(clips.where(F.col("src_row") < stop), path, str(stop))
    assert funnel_rows(funnel_of_counts(read_counts(spark, path))) == want


def test_a_run_cut_off_before_its_copies_leaves_them_to_the_next(clips, spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ledger")

    def dies(*a, **k):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr("clipcurate.plans.curate.record_copies", dies)
        with pytest.raises(KeyboardInterrupt):
            record(clips, path, "cut")
    record(clips, path, "next")
    want = funnel_rows(funnel_by_language(Curator().verdicts(clips)))
    assert funnel_rows(funnel_of_counts(read_counts(spark, path))) == want


def test_streams_and_runs_share_counts(clips, spark, tmp_path):
    path, folder = str(tmp_path / "ledger"), str(tmp_path / "in")
    record(clips.where("src_row < 20"), path, "run")
    for low in (0, 40):
        clips.where(F.col("src_row").between(low, low + 39)).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(clips.schema).parquet(folder)
        curate_stream(stream, path, str(tmp_path / "progress")).awaitTermination()
    want = funnel_rows(funnel_by_language(Curator().verdicts(clips)))
    assert funnel_rows(funnel_of_counts(read_counts(spark, path))) == want


def test_an_imported_clip_is_no_copy_of_itself(clips, spark, tmp_path):
    path = str(tmp_path / "ledger")
    (tmp_path / "doc.json").write_text('{"processed_ids": ["c1"], "metadata": [], "stats": {}}')
    append_ledger(import_ledger(spark, str(tmp_path / "doc.json"), "gu"), path, "import")
    record(clips, path, "run")
    counts = {r.language: r for r in funnel_of_counts(read_counts(spark, path)).collect()}
    plain = {r.language: r for r in funnel_by_language(Curator().verdicts(clips.where("not (language = 'gu' and id = 'c1')"))).collect()}
    assert counts["gu"].duplicates == plain["gu"].duplicates


def test_only_the_buckets_asked_for_are_read(clips, spark, tmp_path):
    path = str(tmp_path / "ledger")
    record(clips, path, "run")
    own = spark.createDataFrame([("c3",)], "id string").select(bucket_of(F.col("id"))).first()[0]
    plan = read_ledger(spark, path, buckets=[own])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"bucket#" in plan.split("PartitionFilters")[1][:400]
    rows = read_ledger(spark, path, buckets=[own])
    assert {r.id for r in rows.collect()} >= {"c3"}
    assert rows.select(F.input_file_name()).distinct().count() == 1
    assert sum(read_ledger(spark, path, buckets=[b]).count() for b in range(BUCKETS)) == read_ledger(spark, path).count()


def files(path):
    return sorted(str(f.relative_to(path)) for f in Path(path).rglob("*.parquet"))


def test_compaction_keeps_rows_and_counts(clips, spark, tmp_path):
    path = str(tmp_path / "ledger")
    for stop in (5, 15, 25, 60):
        record(clips.where(F.col("src_row") < stop), path, str(stop))
    before, counts, many = state(read_ledger(spark, path)), funnel_rows(read_counts(spark, path)), len(files(path))
    key = compact_ledger(spark, path)
    assert state(read_ledger(spark, path)) == before and funnel_rows(read_counts(spark, path)) == counts
    assert len(files(path)) <= BUCKETS < many or len(files(path)) < many
    assert {f.split("/")[0] for f in files(path)} == {f"run_key={key}"}
    assert compact_ledger(spark, path) is None
    record(clips, path, "after")
    assert state(read_ledger(spark, path)) == before
    compact_ledger(spark, path)
    assert state(read_ledger(spark, path)) == before and funnel_rows(read_counts(spark, path)) == counts


@pytest.mark.parametrize("moment", ["before the record", "before the deletion"])
def test_a_crash_in_a_compaction_changes_nothing(clips, spark, tmp_path, monkeypatch, moment):
    path = str(tmp_path / "ledger")
    for stop in (20, 60):
        record(clips.where(F.col("src_row") < stop), path, str(stop))
    before = state(read_ledger(spark, path))

    def dies(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if moment == "before the record":
            m.setattr(increments, "GENERATIONS", "no schema at all(")
        else:
            m.setattr(increments, "delete_folder", dies)
        with pytest.raises(BaseException):
            compact_ledger(spark, path)
    assert state(read_ledger(spark, path)) == before


def test_the_newest_batch_of_a_stream_is_not_compacted(clips, spark, tmp_path):
    path, folder = str(tmp_path / "ledger"), str(tmp_path / "in")
    for low in (0, 20, 40):
        clips.where(F.col("src_row").between(low, low + 19)).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(clips.schema).parquet(folder)
        curate_stream(stream, path, str(tmp_path / "progress")).awaitTermination()
    before = state(read_ledger(spark, path))
    compact_ledger(spark, path)
    assert {f.split("/")[0].split("=")[1].split("-")[0] for f in files(path)} == {"generation", "stream"}
    assert state(read_ledger(spark, path)) == before


def test_copies_are_found_without_a_second_meeting_of_rows_and_ledger(spark):
    from clipcurate.plans.increments import copies_of

    place = "language string, id string, src_file string, src_row long"
    rows = [("en", "a", "f", 1), ("en", "a", "g", 2), ("en", "a", "g", 2), ("en", "b", "f", 3), ("en", "c", "f", 4)]
    rows += [("en", "c", "g", 5), (None, "a", "f", 6), ("en", None, "f", 7), ("en", "d", "h", 8)]
    ledger = [("en", "a", "f", 1), ("en", "b", "f", 3), ("en", "c", None, None), ("en", "d", None, None), ("en", "d", "f", 0)]
    found = [spark.createDataFrame(x, place) for x in (rows, ledger, [])]
    assert sorted(map(tuple, copies_of(*found).collect())) == [("en", "a", "g", 2), ("en", "d", "h", 8)]
    placed = [found[0].where("id in ('a', 'b')"), found[1].where("src_file is not null"), found[2]]
    plan = copies_of(*placed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def speakers_of(clips):
    heard = F.when(F.col("src_row") % 4 == 0, "failed").otherwise("ok").alias("status")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("start_us", "long"), ("end_us", "long"), ("speaker", "string"))]
    return clips.select(F.col("id").alias("clip_id"), *nothing, heard)


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("|")
    return {f for f in files.split("|") if "/shuffle_" in f and f.endswith(".data")}


def test_a_run_shuffles_texts_once_and_leaves_no_shuffle_of_texts_behind(clips, spark, tmp_path, monkeypatch):
    """Disk is what a run over much text ran out of: first copies, speakers and buckets shuffled all texts each."""
    from clipcurate.plans import curate

    plans, append = [], curate.append_ledger

    def seen(verdicts, path, run_id):
        query = verdicts._jdf.queryExecution()
        plans.append(spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(query, "formatted"))
        return append(verdicts, path, run_id)

    noise = F.expr("array_join(transform(sequence(1, 50), i -> sha2(concat(src_row, ':', i), 512)), '')")
    long = clips.withColumn("text", noise)
    before = shuffle_files(spark)
    with monkeypatch.context() as m:
        m.setattr(curate, "append_ledger", seen)
        m.setattr(curate, "IDS_TO_BROADCAST", 0, raising=False)
        with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
            Curator().run_and_record(long, str(tmp_path / "ledger"), speakers_of(long))
    inputs = re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", plans[0])
    assert len([i for i in inputs if re.search("text#|valueWithExtremumOrdering#", i)]) == 1
    texts = long.select("id", "language").distinct().count() * 6_400
    for _ in range(100):
        left = sum(os.path.getsize(f) for f in shuffle_files(spark) - before if os.path.exists(f))
        if left < texts / 4:
            break
        time.sleep(0.1)
    assert left < texts / 4


@pytest.mark.parametrize(
    "languages, to_send, to_ship",
    [(None, 200_000, 1), (None, 0, 1_000), (None, 12, 2), (("gu",), 0, 1), (("gu",), 200_000, 1_000)],
)
def test_what_is_recorded_depends_on_no_limit(clips, spark, tmp_path, monkeypatch, languages, to_send, to_ship):
    """Few and many new clips, ids of many copies, and nulls, which are recorded anew by every run."""
    nulls = [(None, "gu", TEXT, 3000, 1000, "g", 1), (None, "gu", "", 3000, 1000, "g", 2), ("c1", None, TEXT, 3000, 1000, "g", 3)]
    rows = clips.union(spark.createDataFrame([*nulls, ("c99", "gu", None, None, 1000, None, None)], clips.schema))
    monkeypatch.setattr("clipcurate.plans.curate.IDS_TO_BROADCAST", to_send)
    monkeypatch.setattr("clipcurate.operators.resume.COPIES_TO_SHIP", to_ship)
    path, config = str(tmp_path / "ledger"), CurationConfig(languages=languages)
    columns = ("language", "id", "verdict", "copies", "src_file", "src_row", "clean_text", "duration_ms")
    values = lambda df: Counter(tuple(r) for r in df.select(*columns).collect())
    heard = speakers_of(rows)
    part = rows.where("src_row < 9")
    want = values(Curator(config).verdicts(part, heard))
    assert values(Curator(config).run_and_record(part, path, heard).verdicts) == want
    want += values(Curator(config).verdicts(rows, heard, read_ledger(spark, path)))
    assert values(Curator(config).run_and_record(rows, path, heard).verdicts) == want


def test_many_rows_of_a_bucket_are_dealt_to_several_tasks(clips, spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ledger")
    monkeypatch.setattr("clipcurate.sources.ledger.ROWS_PER_TASK", 1)
    monkeypatch.setattr("clipcurate.plans.curate.IDS_TO_BROADCAST", 0)
    spread = clips.withColumn("id", F.concat("id", F.lit("-"), "src_row"))
    heard = speakers_of(spread)
    for stop in (40, 60):
        record = Curator(CurationConfig(run_id=str(stop))).run_and_record
        rows = record(spread.where(F.col("src_row") < stop), path, heard).verdicts
    assert state(rows) == state(Curator().verdicts(spread, heard))
    assert all(r.id in {x.id for x in read_ledger(spark, path, buckets=[r.b]).collect()} for r in rows.select("id", bucket_of(F.col("id")).alias("b")).limit(3).collect())
