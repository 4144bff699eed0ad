"""The permutation, the shards and the round trip of token ids."""

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from clipcurate.llm import bpe
from clipcurate.llm import training_order as to

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(RANKS), special_tokens={}
)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097, 70_000])
def test_feistel_is_a_permutation_with_an_inverse(n):
    f = to.Feistel(n, b"k")
    slots = f.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (f.numbers(slots) == np.arange(n)).all()
    if n > 100:
        assert (slots != to.Feistel(n, b"other").slots(np.arange(n))).any()
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.2


def test_every_document_comes_back_from_its_slots(spark):
    texts = ["", None, "one", "two  spaces\n new line ", " lead", "word " * 300, "é漢  x", "a\n\nb c", "one"]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "no id")], "doc_id long, text string").repartition(3)
    shards = to.materialise(docs, RANKS, public_tokenizers.PATTERN, length=16, per_shard=8)
    rows = shards.collect()
    records, slots = {}, []
    for row in rows:
        stride = len(row.payload) // len(row.sizes)
        assert stride == 32
        assert row.first_slot == row.shard * 8
        for i, (doc, part, size) in enumerate(zip(row.doc_ids, row.parts, row.sizes, strict=True)):
            ids = np.frombuffer(row.payload[i * stride : (i + 1) * stride], "<u2")
            assert (ids[size:] == to.PAD).all()
            records[(doc, part)] = ids[:size].tolist()
            slots.append(row.first_slot + i)
    assert sorted(slots) == list(range(len(slots)))
    end = len(bpe.parse_ranks(RANKS))
    for doc, text in [*enumerate(texts), (None, "no id")]:
        ids = [x for key in sorted((k for k in records if k[0] == doc), key=lambda k: k[1]) for x in records[key]]
        assert ids == [*LIBRARY.encode_ordinary(text or ""), end]
    found = to.positions(shards).collect()
    assert sorted(r.slot for r in found) == sorted(slots)
    assert {(r.doc_id, r.part): r.n_tokens for r in found} == {k: len(v) for k, v in records.items()}


def test_resume_and_empty(spark):
    from clipcurate.session import scratch_path

    docs = spark.createDataFrame([(i, "some words here") for i in range(50)], "doc_id long, text string")
    path = scratch_path(spark, "resume")
    to.materialise(docs, RANKS, public_tokenizers.PATTERN, path=path, per_shard=8)
    assert [r.shard for r in to.read_shards(spark, path, from_slot=20, per_shard=8).orderBy("shard").collect()] == [2, 3, 4, 5, 6]
    assert to.materialise(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_the_order_does_not_depend_on_splits(spark):
    from pyspark.sql import functions as F

    from clipcurate.session import scratch_path

    path = scratch_path(spark, "documents")
    docs = spark.range(0, 3000, 1, 3).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), (F.col("id") % 90).cast("int")).alias("text"))
    docs.write.option("parquet.block.size", 8192).parquet(path)
    found = []
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("3k", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            table = spark.read.parquet(path).select("doc_id", "text", "_metadata.file_name", "_metadata.row_index")
            shards = to.materialise(table, RANKS, public_tokenizers.PATTERN, length=64, place=("file_name", "row_index"))
            found.append({(r.doc_id, r.part): r.slot for r in to.positions(shards).collect()})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found[0] == found[1] and len(found[0]) > 3000


def test_very_long_texts_without_spaces(spark):
    docs = spark.createDataFrame([(1, "ab" * 500_000), (2, "word " * 300_000)], "doc_id long, text string")
    rows = {(r.doc_id, r.part): r.n_tokens for r in to.positions(to.materialise(docs, RANKS, public_tokenizers.PATTERN)).collect()}
    for doc, text in ((1, "ab" * 500_000), (2, "word " * 300_000)):
        assert sum(n for (d, _), n in rows.items() if d == doc) == len(LIBRARY.encode_ordinary(text)) + 1
