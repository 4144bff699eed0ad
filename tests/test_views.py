"""Views of the given tables, over rows of their own."""

import pytest
from pyspark.sql import functions as F

from clipcurate.operators.segments import single_speaker
from queries import views

TEXTS = {1: "a long phrase, no. just one j here; x\n@ failed line, of two", 2: "", 3: None}


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(i, "en", "web", t) for i, t in TEXTS.items()] + [(1, None, "web", "again, another text")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_phrases_do_not_carry_the_text_of_their_clip(spark, folder):
    found = views.diarization(spark, folder)
    above = found._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "Contains(phrase" in above and "Contains(text" not in above
    status = {(r.clip_id, r.status) for r in found.collect()}
    assert status == {("1-0", "ok"), ("1-1", "failed"), ("2-0", "ok")}


def test_hearings_are_the_diarization_of_a_clip_in_one_row(spark, folder):
    clips = views.clips(spark, folder).select("id", "text", "language")
    heard = views.hearings(clips)
    assert sorted((r.id, r.language or "") for r in heard.collect()) == [("1-0", ""), ("1-0", "en"), ("1-1", "en"), ("2-0", "en")]
    rows = heard.dropDuplicates(["id"]).select(F.col("id").alias("clip_id"), F.explode("segments").alias("s"), "status")
    names = ("clip_id", "start_us", "end_us", "speaker", "status")
    table = sorted(views.diarization(spark, folder).select(*names).collect(), key=str)
    assert sorted(rows.select("clip_id", "s.*", "status").select(*names).collect(), key=str) == table
    assert {r.single_speaker for r in single_speaker(rows.select("clip_id", "s.*", "status")).collect()} == {True, False}
