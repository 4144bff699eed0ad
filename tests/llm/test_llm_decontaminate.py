"""Suffix automaton matching against a search for every window."""

import hashlib
import random

import pytest

from clipcurate.llm import decontaminate as dc


def brute_force(doc, items, window):
    covered, found = set(), set()
    for item, words in items:
        size = min(window, len(words))
        wanted = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
        for at in range(len(doc) - size + 1) if wanted else ():
            if tuple(doc[at : at + size]) in wanted:
                found.add(item)
                covered.update(range(at, at + size))
    return covered, found


@pytest.mark.parametrize("seed", range(40))
def test_spans_equal_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(25):
        letters = [bytes([97 + i]) for i in range(rnd.randint(1, 4))]
        window = rnd.randint(1, 5)
        items = [(i, [rnd.choice(letters) for _ in range(rnd.randint(1, 9))]) for i in range(rnd.randint(1, 5))]
        doc = [rnd.choice([*letters, b"zz"]) for _ in range(rnd.randint(0, 30))]
        covered, found = set(), set()
        for first, after, of in dc.Automaton(items, window).spans(doc):
            covered.update(range(first, after))
            found |= of
        assert (covered, found) == brute_force(doc, items, window)


def test_words():
    assert dc.words_of("It's ÉTÉ_2-x\0y") == [b"it", b"s", "ÉtÉ".encode(), b"2", b"x", b"y"]


ITEM = "one two three four five six seven eight nine ten eleven twelve"


def tables(spark):
    docs = spark.createDataFrame(
        [
            (1, f"Before. {ITEM.upper()}! After it, much more of text stands here and goes on for a while, so it stays.", "n", 5),
            (2, ITEM, "n", 5),
            (3, None, "n", None),
            (None, "", "n", 0),
            (4, "one two three four five six seven eight nine TEN", "n", 1),
            (5, "nothing of it", "n", 13),
            (5, "nothing of it", "n", 13),
            (6, "say short item here and there or elsewhere", "n", 1),
        ],
        "doc_id long, text string, n_words string, n_chars long",
    )
    bench = spark.createDataFrame(
        [(7, ITEM), (8, "Short item"), (9, None), (10, "!?"), (None, "unseen"), (7, ITEM)], "item_id long, text string"
    )
    return docs, bench


def test_match_cases(spark):
    docs, bench = tables(spark)
    for block_words in (1, 10_000):
        rows = dc.match(docs, bench, block_words=block_words).collect()
        got = sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in rows)
        assert got == [
            (0, 0, 0, 0, False),
            (1, 30, 12, 1, True),
            (2, 12, 12, 1, True),
            (3, 0, 0, 0, False),
            (4, 10, 10, 1, True),
            (5, 3, 0, 0, False),
            (5, 3, 0, 0, False),
            (6, 8, 2, 1, True),
        ]
        assert {r.items_sha256 for r in rows if r.doc_id == 6} == {hashlib.sha256(b"8").hexdigest()}
        assert {r.items_sha256 for r in rows if r.doc_id == 5} == {hashlib.sha256(b"").hexdigest()}
    assert dc.match(docs, bench.limit(0)).where("contaminated").count() == 0
    assert dc.match(docs.limit(0), bench).count() == 0


def test_remove_cuts_spans_and_drops_copies(spark):
    docs, bench = tables(spark)
    kept = {(r.doc_id, r.text, r.n_chars) for r in dc.remove(docs, bench).collect()}
    cut = "Before. ! After it, much more of text stands here and goes on for a while, so it stays."
    without = "say  here and there or elsewhere"
    assert kept == {
        (1, cut, len(cut)), (3, None, None), (None, "", 0), (5, "nothing of it", 13), (6, without, len(without)),
    }
    assert dc.remove(docs, bench).columns == docs.columns
