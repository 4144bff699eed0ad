"""CSV with line breaks inside texts: many small splits against Spark's one-task reader."""

import random

import pytest

from clipcurate.sources import manifests, split_csv


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "97")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


def field(rng):
    text = "".join(rng.choice('ab,"\n é') for _ in range(rng.choice([0, 3, 8, 30, 300])))
    return '"' + text.replace('"', '""') + '"'


@pytest.mark.parametrize("seed,end", [(0, "\n"), (1, "\n"), (2, "\r\n")])
def test_as_the_reader_for_whole_files(spark, tmp_path, small_splits, seed, end):
    rng = random.Random(seed)
    for part in range(2):
        lines = ["file_name,transcription,duration_seconds"]
        lines += [f"wavs/{part}-{i}.wav,{field(rng)},{i}.5" for i in range(60)]
        lines += ["", f"wavs/{part}-short.wav", f'"wavs/{part},""x"".wav",plain,']
        (tmp_path / f"{part}.csv").write_bytes(end.join("\n".join(lines).split("\n")).encode())
    got = manifests.read_csv_manifest(spark, str(tmp_path), split=True)
    want = manifests.read_csv_manifest(spark, str(tmp_path))
    rows = sorted(map(str, got.collect()))
    assert rows == sorted(map(str, want.collect())) and len(rows) == 124
    assert split_csv.quoted_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    assert want.rdd.getNumPartitions() <= 2


def test_a_text_longer_than_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(str(i) for i in range(500))
    (tmp_path / "m.csv").write_text(f'file_name,transcription\na,"{long}"\nb,"x"\nc,"{long}\n"', "utf-8")
    rows = manifests.read_csv_manifest(spark, str(tmp_path / "m.csv"), split=True).collect()
    assert sorted((r.file_name, r.transcription) for r in rows) == [("a", long), ("b", "x"), ("c", long + "\n")]


def test_columns_by_name_and_no_rows(spark, tmp_path):
    (tmp_path / "m.csv").write_text('speaker,transcription,file_name\ns,"one, ""two""\nthree",wavs/a.wav\n', "utf-8")
    (row,) = manifests.read_csv_manifest(spark, str(tmp_path / "m.csv"), split=True).collect()
    assert tuple(row) == ("wavs/a.wav", 'one, "two"\nthree', None)
    (tmp_path / "e.csv").write_text("file_name,transcription\n", "utf-8")
    assert manifests.read_csv_manifest(spark, str(tmp_path / "e.csv"), split=True).count() == 0


def test_an_open_quote_is_an_error(spark, tmp_path):
    (tmp_path / "m.csv").write_text('file_name,transcription\na,"x\nb,y\n', "utf-8")
    with pytest.raises(ValueError, match="ends inside a quoted text"):
        manifests.read_csv_manifest(spark, str(tmp_path / "m.csv"), split=True)
