import json
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clipcurate.config import CurationConfig
from clipcurate.operators import pack
from clipcurate.operators.verdict import KEPT
from clipcurate.plans.curate import Curator
from clipcurate.sinks import tables, text, vocabulary
from clipcurate.sources import clips as clip_source
from clipcurate.sources import ledger, manifests
from clipcurate.sources.vocabulary import read_vocabulary

TEXTS = ['he said "so, yes"', '"outer quotes"', "plain, with comma", "કેમ છો, friend"]


def lines(path):
    parts = sorted(Path(path).glob("part-*"))
    return [line for p in parts for line in p.read_text("utf-8").splitlines()]


@pytest.fixture
def kept(make_clips):
    clips = make_clips(*[(f"id{i}", "gu", t, 2.5) for i, t in enumerate(TEXTS)])
    return Curator().run(clips).kept


def test_manifest_bytes(kept, tmp_path):
    paths = text.write_manifests(kept, str(tmp_path), "gu")
    found = lines(paths["metadata.csv"])
    header = "file_name,transcription,duration_seconds"
    assert found[0] == header
    assert [x for x in found if x != header] == [
        f'wavs/id{i}.wav,"{t.replace(chr(34), chr(34) * 2)}",2.5' for i, t in enumerate(TEXTS)
    ]
    assert lines(paths["wav.scp"]) == [f"id{i} {tmp_path}/gu/wavs/id{i}.wav" for i in range(4)]
    assert lines(paths["text"]) == [f"id{i} {t}" for i, t in enumerate(TEXTS)]
    assert lines(paths["utt2spk"]) == [f"id{i} spk_hf_gu" for i in range(4)]


def test_manifests_come_from_one_sort_and_as_before(make_clips, tmp_path):
    clips = make_clips(*[(f"id{i:04d}", "gu", f"text {i} " + "x" * 20, 2.5) for i in range(3000)])
    kept = Curator().run(clips).kept
    plan = text._ranged(kept.select("id", F.struct(*[F.col("text").alias(n) for n in text.MANIFESTS]).alias("lines")))
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert shown.count("rangepartitioning") == 1
    spark = kept.sparkSession
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paths = text.write_manifests(kept, str(tmp_path), "gu")
        text.write_lines(text.csv_lines(kept), str(tmp_path / "csv"), text.names.CSV_HEADER)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for writer, file in ((text.text_lines, "text"), (text.speaker_lines, "utt2spk")):
        text.write_lines(writer(kept), str(tmp_path / file))
        assert lines(paths[file]) == lines(tmp_path / file) and len(lines(paths[file])) == 3000
    header = text.names.CSV_HEADER
    parts = sorted(Path(paths["metadata.csv"]).glob("part-*"))
    assert len(parts) > 1 and all(p.read_text().splitlines()[0] == header for p in parts)
    body = lambda folder: [x for x in lines(folder) if x != header]
    assert body(paths["metadata.csv"]) == body(tmp_path / "csv")
    assert sorted(p.name for p in (tmp_path / "gu").iterdir()) == ["metadata.csv", "text", "utt2spk", "wav.scp"]


def test_a_failed_write_leaves_the_older_manifests(kept, tmp_path):
    paths = text.write_manifests(kept, str(tmp_path), "gu")
    before = {p: lines(p) for p in paths.values()}
    broken = kept.withColumn("text", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        text.write_manifests(broken, str(tmp_path), "gu")
    assert {p: lines(p) for p in paths.values()} == before and len(list((tmp_path / "gu").iterdir())) == 4


def test_manifests_without_clips(kept, spark, tmp_path):
    paths = text.write_manifests(kept, str(tmp_path), "hi")
    assert {Path(p).name: lines(p) for p in paths.values()} == {
        "metadata.csv": [text.names.CSV_HEADER], "wav.scp": [], "text": [], "utt2spk": [],
    }
    assert manifests.read_csv_manifest(spark, paths["metadata.csv"]).count() == 0


def test_every_part_file_has_the_header(make_clips, tmp_path):
    clips = make_clips(*[(f"id{i:04d}", "gu", "x" * 30, 2.5) for i in range(400)])
    rows = text.csv_lines(Curator().run(clips).kept)
    spark = rows.sparkSession
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        text.write_lines(rows, str(tmp_path / "csv"), "h")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted((tmp_path / "csv").glob("part-*"))
    assert len(parts) > 1
    assert all(p.read_text().splitlines()[0] == "h" for p in parts)
    assert len(lines(tmp_path / "csv")) == 400 + len(parts)


def test_csv_comes_back_and_converts(kept, spark, tmp_path):
    paths = text.write_manifests(kept, str(tmp_path), "gu")
    back = manifests.read_csv_manifest(spark, paths["metadata.csv"])
    rows = back.orderBy("file_name").collect()
    assert [r.transcription for r in rows] == TEXTS
    assert {r.duration_seconds for r in rows} == {2.5}
    converted = [r.line for r in text.csv_to_pipe(back).orderBy("id").collect()]
    assert converted == [
        f"wavs/id{i}.wav|{t.strip(chr(34))}|{t.strip(chr(34))}" for i, t in enumerate(TEXTS)
    ]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        'speaker,transcription,file_name\ns,"one, ""two""\nthree",wavs/a.wav\n', "utf-8"
    )
    (row,) = manifests.read_csv_manifest(spark, str(tmp_path / "m.csv")).collect()
    assert tuple(row) == ("wavs/a.wav", 'one, "two"\nthree', None)


@pytest.mark.parametrize("seed", range(3))
def test_any_text_survives_the_csv_manifest(spark, make_clips, tmp_path, seed):
    rng = random.Random(seed)
    signs = 'ab ,;"\'\\#\t/|>.\u0a95\U0001f600'
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(8, 40))) for _ in range(200)]
    config = CurationConfig(min_cps=0.0, max_cps=1000.0)
    kept = Curator(config).run(make_clips(*[(f"i{n}", "gu", t, 2.5) for n, t in enumerate(texts)])).kept
    paths = text.write_manifests(kept, str(tmp_path), "gu")
    want = {r.wav_path: r.text for r in kept.collect()}
    for multi_line in (True, False):
        back = manifests.read_csv_manifest(spark, paths["metadata.csv"], multi_line)
        assert {r.file_name: r.transcription for r in back.collect()} == want
    assert len(want) > 150


def test_pipe_manifest_needs_two_fields(spark, tmp_path):
    (tmp_path / "m.txt").write_text(" a.wav|one|two \nlonely\n\nb.wav|x\nc.wav||\n", "utf-8")
    rows = manifests.read_pipe_manifest(spark, str(tmp_path / "m.txt")).collect()
    assert sorted(tuple(r) for r in rows) == [
        ("a.wav", "one", "two"), ("b.wav", "x", None), ("c.wav", "", ""),
    ]


def test_text_list_keeps_order_and_drops_blanks(spark, tmp_path):
    (tmp_path / "t.txt").write_text("  one　\n\n\t\nzwei \r\nthree", "utf-8")
    rows = manifests.read_texts(spark, str(tmp_path / "t.txt")).orderBy(*manifests.TEXT_ORDER)
    assert [r.text for r in rows.collect()] == ["one", "zwei", "three"]


def test_text_sources_by_precedence(spark, tmp_path):
    (tmp_path / "t.txt").write_text("from file", "utf-8")

    def chosen(*args):
        return [r.text for r in manifests.choose_texts(spark, *args).orderBy("src_pos").collect()]

    assert chosen(str(tmp_path / "t.txt"), ["inline"], ["default"]) == ["from file"]
    assert chosen(None, ["in", "line"], ["default"]) == ["in", "line"]
    assert chosen(None, None, ["default"]) == ["default"]


def test_reference_listing(spark, tmp_path):
    for name in ("b.wav", "a.flac", "c.mp3", "D.WAV", "x.txt", "a.b.wav"):
        (tmp_path / name).write_bytes(b"12345")
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "z.wav").write_bytes(b"1")
    rows = manifests.list_references(spark, str(tmp_path))
    assert [(r.name, r.ref_name, r.length) for r in rows.collect()] == [
        ("a.b.wav", "a.b", 5), ("a.flac", "a", 5), ("b.wav", "b", 5), ("c.mp3", "c", 5),
    ]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1].splitlines()[0]
    (tmp_path / "none").mkdir()
    assert manifests.list_references(spark, str(tmp_path / "none")).count() == 0
    assert manifests.list_wavs(spark, str(tmp_path)).count() == 2


def test_ledger_document(spark, tmp_path):
    doc = {
        "processed_ids": ["a", "b"],
        "metadata": [{"wav_path": "wavs/a.wav", "text": "hi", "speaker": "s", "duration": 2.5, "cps": 7.0}],
        "stats": {"total": 5, "kept": 1},
    }
    (tmp_path / "l.json").write_text(json.dumps(doc, indent=2))
    rows = {r.id: r for r in ledger.read_ledger_documents(spark, str(tmp_path / "l.json"), "gu").collect()}
    assert rows["a"].verdict == KEPT and rows["a"].clean_text == "hi" and rows["a"].duration == 2.5
    assert rows["b"].verdict is None
    stats = ledger.read_ledger_stats(spark, str(tmp_path / "l.json")).first()
    assert (stats.total, stats.kept, stats.cps_rejected) == (5, 1, 0)


def test_ledger_document_without_parts(spark, tmp_path):
    (tmp_path / "l.json").write_text("{}")
    assert ledger.read_ledger_documents(spark, str(tmp_path / "l.json"), "gu").count() == 0
    assert set(ledger.read_ledger_stats(spark, str(tmp_path / "l.json")).first()) == {0}


def test_imported_ledger_resumes(spark, make_clips, tmp_path):
    (tmp_path / "l.json").write_text(json.dumps({"processed_ids": ["a"]}))
    clips = make_clips(("a", "gu", "x" * 30, 3.0), ("b", "gu", "x" * 30, 3.0))
    done = ledger.read_ledger_documents(spark, str(tmp_path / "l.json"), "gu")
    assert [r.id for r in Curator().verdicts(clips, ledger=done).collect()] == ["b"]


def test_vocabulary_document(spark, tmp_path):
    vocab = {"[UNK]": 0, '"': 1, "ક": 2, "\\": 3}
    doc = {"version": "1.0", "model": {"type": "x", "vocab": vocab}}
    (tmp_path / "v.json").write_text(json.dumps(doc, ensure_ascii=False, indent=2), "utf-8")
    rows = read_vocabulary(spark, str(tmp_path / "v.json"))
    assert {r.token: r.token_id for r in rows.collect()} == vocab
    vocabulary.write_vocabulary(rows, str(tmp_path / "out"))
    (line,) = lines(tmp_path / "out")
    assert json.loads(line) == {"model": {"vocab": vocab}}


def test_too_many_tokens_for_a_document(spark, monkeypatch):
    monkeypatch.setattr(vocabulary, "MAX_DOCUMENT_TOKENS", 2)
    rows = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "token string, token_id int")
    with pytest.raises(ValueError):
        vocabulary.vocabulary_document(rows)


def packed(make_clips, path, n=70):
    clips = make_clips(*[(f"{i:03d}", "hi" if i % 2 else "gu", "x" * 30, 2.5) for i in range(n)])
    again = clips.withColumn("src_row", F.col("src_row") + 1000)
    audio = clips.union(again).select(
        "src_file", "src_row",
        F.struct(
            F.encode(F.concat_ws(":", "id", "src_row"), "UTF-8").alias("bytes"), "sampling_rate"
        ).alias("audio"),
    )
    sharded = pack.assign_shards(Curator().run(clips.union(again)).kept, shard_rows=30)
    return tables.write_shards(tables.packed_rows(sharded, audio), str(path))


def test_shards_are_full_and_cross_languages(make_clips, spark, tmp_path):
    out = packed(make_clips, tmp_path)
    rows = spark.read.parquet(out)
    sizes = {r.shard: r["count"] for r in rows.groupBy("shard").count().collect()}
    assert sizes == {"shard_00000": 30, "shard_00001": 30, "shard_00002": 10}
    mixed = rows.where("shard = 'shard_00001'").select("language").distinct().count()
    assert mixed == 2
    files = [f for f in Path(out).rglob("*.parquet")]
    assert len(files) == 3 and all(".snappy." in f.name for f in files)


def test_packed_rows_keep_rate_audio_and_order(make_clips, spark, tmp_path):
    import pyarrow.parquet as pq

    out = packed(make_clips, tmp_path)
    rows = spark.read.parquet(out).collect()
    assert {r.audio.sampling_rate for r in rows} == {1000}
    assert all(bytes(r.audio.bytes).decode() == f"{r.id}:{int(r.id)}" for r in rows)
    (file,) = Path(out, "shard=shard_00001").glob("*.parquet")
    keys = [(r["language"], r["id"]) for r in pq.ParquetFile(file).read().to_pylist()]
    assert keys == sorted(keys)
    schema = spark.read.parquet(out).drop("shard").dtypes
    assert dict(schema)["duration_sec"] == "double" and dict(schema)["cps"] == "double"


def test_clean_probe_and_scan(make_clips, spark, tmp_path):
    assert not clip_source.clean_exists(spark, str(tmp_path / "nowhere"), "gu")
    (tmp_path / "empty").mkdir()
    assert not clip_source.clean_exists(spark, str(tmp_path / "empty"), "gu")
    out = packed(make_clips, tmp_path / "p")
    assert clip_source.clean_exists(spark, out, "gu")
    assert not clip_source.clean_exists(spark, out, "de")
    assert clip_source.read_clean(spark, out, "hi").count() == 35


def test_raw_scan_has_source_positions(spark, tmp_path):
    rows = spark.range(10).select(
        F.col("id").cast("string"),
        F.struct(F.lit(b"x").alias("bytes"), F.lit(8).alias("sampling_rate")).alias("audio"),
        F.lit("t").alias("text"), F.lit("gu").alias("language"),
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "raw"))
    got = clip_source.read_raw(spark, str(tmp_path / "raw")).where("id >= 5").collect()
    assert {(r.id, r.src_row) for r in got} == {(str(i), i) for i in range(5, 10)}
    assert all(r.src_file.endswith(".parquet") for r in got)


def test_stats_are_one_json_file(make_clips, spark, tmp_path):
    rows = spark.createDataFrame([("gu", 3)], "language string, clips long")
    tables.write_stats(rows, str(tmp_path / "s"))
    (line,) = [x for p in Path(tmp_path / "s").glob("*.json") for x in p.read_text().splitlines()]
    assert json.loads(line) == {"language": "gu", "clips": 3}
    assert os.path.exists(tmp_path / "s" / "_SUCCESS")
