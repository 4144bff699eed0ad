import math

import pytest
from pyspark.sql import functions as F

from clipcurate.operators import samples, vectors, vocab
from clipcurate.plans.vocabulary import grow_vocabulary

GU = "કેમ"


@pytest.fixture
def base(spark):
    return spark.createDataFrame([("[UNK]", 0), ("a", 1), (GU[0], 7)], "token string, token_id int")


def test_vocabulary_grows_densely(spark, base):
    texts = spark.createDataFrame([(GU + "a \U0001f600",), (GU[::-1],), ("",)], "text string")
    rows = {r.token: r.token_id for r in grow_vocabulary(texts, base).collect()}
    added = sorted(set(GU) - {GU[0]})
    assert rows == {"[UNK]": 0, "a": 1, GU[0]: 7, **{c: 8 + i for i, c in enumerate(added)}}
    stats = vocab.vocab_stats(grow_vocabulary(texts, base)).first()
    assert (stats.max_token_id, stats.vocab_size) == (9, 5)


def test_growing_again_adds_nothing(spark, base):
    texts = spark.createDataFrame([(GU,)], "text string")
    once = grow_vocabulary(texts, base).select("token", "token_id")
    assert grow_vocabulary(texts, once).where("added").count() == 0


def test_growing_from_nothing_starts_at_zero(spark, base):
    texts = spark.createDataFrame([("ba",)], "text string")
    rows = grow_vocabulary(texts, base.where("false"), script=None).collect()
    assert {r.token: r.token_id for r in rows} == {"a": 0, "b": 1}


def test_character_counts(spark):
    texts = spark.createDataFrame([("aab\U0001f600",), ("b",)], "text string")
    assert {r.token: r.n for r in vocab.character_counts(texts).collect()} == {"a": 2, "b": 2, "\U0001f600": 1}


def test_encoding(spark, base):
    table = vocab.char_id_table(base, 0)
    rows = spark.createDataFrame([(0, "a" + GU + "\U0001f600"), (1, "")], "i int, text string")
    got = rows.orderBy("i").select(vocab.encode_characters(F.col("text"), table, 0)).collect()
    assert [r[0] for r in got] == [[1, 7, 0, 0, 0], []]


def test_mean_vector(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, -2.0]), (1, [4.0, 0.5])]
    df = spark.createDataFrame(rows, "g int, vec array<float>")
    whole = vectors.mean_vector(df).first().mean_vec
    assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(whole, [8 / 3, 0.5 / 3]))
    groups = {r.g: r.mean_vec for r in vectors.mean_vector(df, "g").collect()}
    assert groups == {0: [1.0, 2.0], 1: [3.5, -0.75]}


def test_new_tokens_start_at_the_mean(spark):
    known = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "token_id int, vec array<float>")
    new = spark.createDataFrame([(2,), (3,)], "token_id int")
    got = {r.token_id: (r.vec, r.added) for r in vectors.extend_vectors(known, new).collect()}
    assert got == {
        0: ([1.0, 2.0], False), 1: ([3.0, 4.0], False), 2: ([2.0, 3.0], True), 3: ([2.0, 3.0], True),
    }


@pytest.fixture
def rows(spark):
    data = [("a", "gu", [1, 2], [5, 6, 7], [0.5]), ("b", "gu", [1] * 4, [5], [0.5]), ("c", "hi", [1], [5] * 9, [0.5])]
    return spark.createDataFrame(
        data,
        "id string, language string, text_tokens array<int>, speech_tokens array<int>, speaker_emb array<float>",
    )


def test_length_limits(rows):
    assert [r.id for r in samples.limit_lengths(rows, 3, 5).collect()] == ["a"]
    cut = {r.id: (len(r.text_tokens), len(r.speech_tokens)) for r in samples.limit_lengths(rows, 3, 5, cut=True).collect()}
    assert cut == {"a": (2, 3), "b": (3, 1), "c": (1, 5)}
    counts = {r.language: tuple(r)[1:] for r in samples.over_limit_counts(rows, 3, 5).collect()}
    assert counts == {"gu": (1, 0, 1), "hi": (0, 1, 0)}


def test_layout_and_dropout(rows):
    laid = samples.layout(rows, prompt_len=2, stop_id=0)
    a = laid.where("id = 'a'").first()
    assert a.prompt_tokens == [5, 6] and a.target_tokens == [5, 6, 7, 0]
    assert a.labels == [-100, -100, 7, 0]
    dropped = samples.drop_conditioning(laid, 1, percent=100).where("id = 'a'").first()
    assert dropped.prompt_tokens == [0, 0] and dropped.speaker_emb == [0.0] and dropped.speech_tokens == [5, 6, 7]
    kept = samples.drop_conditioning(laid, 1, percent=0).where("id = 'a'").first()
    assert kept.prompt_tokens == [5, 6] and kept.speaker_emb == [0.5]
