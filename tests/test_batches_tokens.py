"""Batches under a limit of padded tokens, and vocabularies of several characters."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from clipcurate.operators import batches, tokens


def plan(spark, lengths, limit, width=8):
    rows = [(f"{i:05d}", n) for i, n in enumerate(lengths)]
    return batches.batch_plan(spark.createDataFrame(rows, "id string, length int"), limit, width)


def by_batch(rows):
    out = {}
    for r in rows:
        out.setdefault(r.batch_no, []).append(r)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_batches_hold_every_sample_and_keep_the_limit(spark, seed):
    rng = random.Random(seed)
    # A third of the samples has one length; some are empty, some longer than the limit.
    lengths = [rng.choice([17, 17, rng.randint(0, 90), rng.randint(0, 300)]) for _ in range(700)] + [0, None, 1, 900]
    rows = plan(spark, lengths, 240).collect()
    assert sorted((r.id, r.length) for r in rows) == [(f"{i:05d}", n or 0) for i, n in enumerate(lengths)]
    found = by_batch(rows)
    assert sorted(found) == list(range(len(found)))
    order = sorted((r.length, r.id) for r in rows)
    assert [x for n in sorted(found) for x in sorted((r.length, r.id) for r in found[n])] == order
    for batch in found.values():
        longest = max(r.length for r in batch)
        assert len(batch) == 1 or longest * len(batch) <= 240
        assert longest - min(r.length for r in batch) <= 8
        for r in batch:
            assert (r.batch_rows, r.batch_length) == (len(batch), longest)
            assert r.padding_share == (0.0 if longest == 0 else (longest - r.length) / longest)
    # Only the last batch of a band has room for one more.
    bands = {}
    for n in sorted(found):
        bands.setdefault((max(found[n][0].length, 1) - 1) // 8, []).append(len(found[n]))
    for band, sizes in bands.items():
        assert set(sizes[:-1]) <= {max(240 // ((band + 1) * 8), 1)}


def test_summary_and_no_samples(spark):
    row = batches.batch_summary(plan(spark, [8, 7, 8, 8, 9], 16), grad_accum=2, epochs=3).first()
    assert tuple(row) == (5, 3, 40, 41, 2, 6)
    assert tuple(batches.batch_summary(plan(spark, [], 16)).first()) == (0, 0, 0, 0, 0, 0)


def reference(text, vocab, unknown, clusters):
    ends = {m.end() for m in regex.finditer(r"\X", text)} if clusters else set(range(len(text) + 1))
    out, i = [], 0
    while i < len(text):
        close = min(e for e in ends if e > i)
        fits = [t for t in vocab if text.startswith(t, i)]
        whole = [t for t in fits if i + len(t) in ends]
        best = max(whole or [t for t in fits if i + len(t) <= close], key=len, default=None)
        out.append(unknown if best is None else vocab[best])
        i += len(best or "x")
    return out


@pytest.mark.parametrize("clusters", [True, False])
def test_the_longest_token_against_a_plain_search(spark, clusters):
    rng = random.Random(7)
    signs = "abcકા્ષ́\U0001f600‍"
    vocab = {"".join(rng.choice(signs) for _ in range(rng.randint(1, 4))): n for n in range(60)}
    texts = ["".join(rng.choice(signs + "z") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string").repartition(3)
    table = spark.createDataFrame([*vocab.items(), ("", 999), (next(iter(vocab)), 998)], "token string, token_id int")
    got = tokens.encode_tokens(rows, table, -1, clusters=clusters).collect()
    assert {r.n: r.token_ids for r in got} == {n: reference(t, vocab, -1, clusters) for n, t in enumerate(texts)}


def test_clusters_stay_whole(spark):
    rows = spark.createDataFrame([("કા",), ("કાક",), (None,), ("",)], "text string")
    letters = [("ક", 1), ("ા", 2)]
    for vocab, want in (
        (letters, {"કા": [1, 2], "કાક": [1, 2, 1]}),
        ([*letters, ("કા", 3)], {"કા": [3], "કાક": [3, 1]}),
        # This token ends with a letter of the next cluster, so it is no token where a sign follows.
        ([*letters, ("aક", 4), ("a", 5)], {"કા": [1, 2], "કાક": [1, 2, 1]}),
    ):
        table = spark.createDataFrame(vocab, "token string, token_id int")
        got = {r.text: r.token_ids for r in tokens.encode_tokens(rows, table, -1).collect()}
        assert got == {**want, None: None, "": []}
    inside = tokens.encode_tokens(spark.createDataFrame([("aકા",)], "text string"), table, -1)
    assert inside.first().token_ids == [5, 1, 2]


def test_long_text_and_large_vocabulary(spark, monkeypatch):
    table = spark.createDataFrame([("ab", 1), ("a", 2)], "token string, token_id int")
    rows = spark.range(1).select(F.repeat(F.lit("aba"), 100_000).alias("text"))
    ids = tokens.encode_tokens(rows, table, -1).first().token_ids
    assert len(ids) == 200_000 and ids[:3] == [1, 2, 1]
    monkeypatch.setattr(tokens, "MAX_TOKENS", 1)
    with pytest.raises(ValueError):
        tokens.encode_tokens(rows, table, -1)


@pytest.mark.parametrize("dense", (0, tokens.DENSE_STEPS))
def test_places_of_many_texts_step_together(monkeypatch, dense):
    monkeypatch.setattr(tokens, "DENSE_STEPS", dense)
    monkeypatch.setattr(tokens, "CODES_AT_ONCE", 9)
    rnd = random.Random(5)
    for _ in range(200):
        vocab = [("".join(rnd.choice("ab \0é😀") for _ in range(rnd.randint(1, 3))), i) for i in range(rnd.randint(0, 8))]
        trie = tokens.Trie(vocab)
        texts = ["".join(rnd.choice("ab \0é😀\ud800") for _ in range(rnd.randint(0, 9))) for _ in range(7)]
        found = tokens.Table(trie).encode(texts, -1)
        assert [ids.tolist() for ids in found] == [trie.encode(t, -1, False) for t in texts]
    assert tokens.Table(trie).encode([], -1) == []
