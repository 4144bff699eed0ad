"""Best-two-fit against packing bin by bin, and token pieces against the library."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from clipcurate.llm import packing
from clipcurate.llm.common import byte_slices
from clipcurate.llm.words import WordIds

WORDS = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = WordIds(WORDS).library


def bin_by_bin(items, capacity):
    """Best-two-fit as it is told: longest first, then two documents for the smallest one."""
    left, bins = Counter(items), []
    while left:
        gap, inside = capacity, []
        for size in sorted(left.elements(), reverse=True):
            if size <= gap:
                inside.append(size)
                gap -= size
        left -= Counter(inside)
        if gap and len(inside) > 1:
            smallest, best = min(inside), (0, 0, 0)
            for x in left:
                for y in left:
                    if y <= x and x + y <= gap + smallest and (x != y or left[x] > 1):
                        best = max(best, (x + y, x, y))
            if best[0] > smallest:
                inside.remove(smallest)
                left[smallest] += 1
                inside += best[1:]
                left -= Counter(best[1:])
        bins.append(tuple(sorted(inside)))
    return Counter(bins)


def bins_of(made, counts):
    bins = {}
    for length, n in counts.items():
        for number, offset in zip(*made.place(np.full(n, length), np.arange(n)), strict=True):
            bins.setdefault(int(number), []).append((int(offset), length))
    assert sorted(bins) == list(range(made.bins))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
    return Counter(tuple(sorted(size for _, size in places)) for places in bins.values())


@pytest.mark.parametrize("seed", range(60))
def test_plan_is_that_of_packing_bin_by_bin(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 30, 100])
    top = max(1, int(capacity * rng.choice([0.3, 0.6, 1])))
    counts = Counter(rng.randint(1, top) for _ in range(rng.choice([1, 5, 40, 150])))
    assert bins_of(packing.plan(counts, capacity), counts) == bin_by_bin(counts.elements(), capacity)


def test_plan_grows_with_lengths_not_with_documents():
    rng = random.Random(1)
    counts = Counter(min(2048, int(rng.lognormvariate(5.5, 1.2)) + 1) for _ in range(20_000))
    many = packing.plan({k: n * 10**9 for k, n in counts.items()})
    tokens = sum(k * n for k, n in counts.items())
    assert len(many.length) < 20_000
    assert tokens * 10**9 / 2048 <= many.bins < 1.01 * tokens * 10**9 / 2048
    assert packing.plan({}).bins == 0


ODD = [
    "", " ", "two  spaces\n\nand\ttabs\r\n", "don't 'S O'Neil's", "İstanbul ΣΑΣ ÀÉß ÿŸ × ÷ ª º µ", "é x́",
    "a\x0bb c\x1cd\x85e\x00", "<|endoftext|> x<|startoftext|>", "日本語 テスト 123abc ½ ﬁ", "###a1b2!! x---", "A" * 3000,
]


def test_ids_are_the_librarys():
    words = WordIds(WORDS)
    found = words.encode(pa.array(ODD))
    assert [x.tolist() for x in found] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in ODD]
    assert [x.tolist() for x in words.encode(pa.array(ODD)[3:6])] == [x.tolist() for x in found[3:6]]
    assert words.encode(pa.array([], pa.string())) == []


def test_slices_by_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 30, "", "c" * 5, "d" * 5])], names=["t"])
    assert [s.num_rows for s in byte_slices(batch, "t", 12)] == [2, 1, 3]


def test_every_piece_has_its_place(spark):
    long = "lorem ipsum dolor " * 3000
    texts = [*ODD, None, long, "same text", "same text"]
    rows = [(i, t, -1) for i, t in enumerate(texts)] + [(None, "no id", -1), (3, "a repeated id", -1), (3, "a repeated id", -1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").withColumnRenamed("length", "rank").repartition(3)
    found = packing.pack(docs, WORDS).collect()
    narrow = packing.pack(docs, WORDS, keep_ids=False)
    assert "ids" not in narrow.columns
    assert Counter((r.id, r.piece, r.ids_crc32) for r in narrow.collect()) == Counter((r.id, r.piece, r.ids_crc32) for r in found)
    want = Counter()
    for doc, text, _ in rows:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        for n, start in enumerate(range(0, len(ids), 2048)):
            want[doc, n, start, tuple(ids[start : start + 2048])] += 1
    got = Counter((r.id, r.piece, r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in found)
    assert got == want
    assert all(r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids) for r in found)
    bins = {}
    for r in found:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(bins) == list(range(len(bins)))
    for places in bins.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048
    assert Counter(tuple(sorted(n for _, n in p)) for p in bins.values()) == bin_by_bin([r.length for r in found], 2048)


def test_other_splits_give_the_same_bins(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") * 7 % 900).cast("int")).alias("text"))
    one, two = (
        Counter(tuple(sorted(r[0])) for r in packing.pack(docs.repartition(n), WORDS).groupBy("sequence_id").agg(F.collect_list("length")).select("collect_list(length)").collect())
        for n in (1, 7)
    )
    assert one == two


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id string, text string"), WORDS).count() == 0


def test_ids_stay_in_the_task_when_only_the_plan_is_wanted(spark):
    docs = spark.createDataFrame([(1, "one text"), (2, None), (3, "word " * 5000)], "doc_id long, text string")
    whole, narrow = (packing.pieces(docs, WORDS, keep_ids=keep) for keep in (True, False))
    assert narrow.columns == [c for c in whole.columns if c != "ids"]
    assert sorted(map(tuple, narrow.collect())) == sorted(map(tuple, whole.drop("ids").collect()))
