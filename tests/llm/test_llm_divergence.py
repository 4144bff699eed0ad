"""The transducer against a sorted list, and the audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from clipcurate.llm import divergence
from clipcurate.llm.transducer import Transducer, build


def words(seed, n, letters="abcé"):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 8, 70]))).encode() for _ in range(n)})


@pytest.mark.parametrize("n", [0, 1, 5, 60, 800])
def test_ordinals_are_places_in_the_sorted_list(n):
    terms = words(n, n)
    arcs = Transducer.from_bytes(build(terms).to_bytes())
    probes = [*terms, *[t + b"a" for t in terms], *[t[:-1] for t in terms if len(t) > 1], b"zzz"]
    lengths = np.array([len(p) for p in probes])
    found = arcs.ordinals(np.frombuffer(b"".join(probes), np.uint8), np.cumsum(lengths) - lengths, lengths)
    place = {t: i for i, t in enumerate(terms)}
    assert found.tolist() == [place.get(p, -1) for p in probes]
    assert [arcs.term(i) for i in range(len(terms))] == terms


def test_the_transducer_is_minimal():
    terms = words(3, 300)
    endings = defaultdict(set)
    for t in terms:
        for i in range(len(t) + 1):
            endings[t[:i]].add(t[i:])
    assert len(build(terms).final) == len({frozenset(e) for e in endings.values()})


def test_unsorted_terms_are_refused():
    for bad in ([b"b", b"a"], [b"a", b"a"], [b""]):
        with pytest.raises(ValueError):
            build(bad)


def test_long_division_is_exact():
    n = np.array([1, 7, 10**12, 9 * 10**14])
    total = np.array([3, 7, 10**14 + 7, 9 * 10**14 + 1])
    assert divergence.probability(n, total).tolist() == [1 + 10**9 * int(a) // int(b) for a, b in zip(n, total, strict=True)]


def test_distinct_terms_are_told_apart_exactly():
    rng = random.Random(5)
    spelled = ["a", "ab", "abcdefgh", "abcdefghi", "abcdefghj", "é" * 8, "é" * 9, "x" * 16, "x" * 17, "y" * 64, "y" * 65, "y" * 66, "Abcdefgh"]
    texts = ["", *[" ".join(rng.choice(spelled) for _ in range(40)) + rng.choice(["", ".", " 1"]) for _ in range(30)], "", "b"]
    cut = pa.array(["left out", *texts, "left out"]).slice(1, len(texts))
    low, text, starts, lengths = divergence.occurrences(cut)
    one, term = divergence.distinct_terms(low, starts, lengths)
    found = [low[s : s + n].tobytes() for s, n in zip(starts, lengths, strict=True)]
    wanted = [(i, t) for i, x in enumerate(texts) for t in re.findall(rb"[a-z\x80-\xff]+", x.encode().lower())]
    assert list(zip(text.tolist(), found, strict=True)) == wanted
    assert [found[i] for i in one[term]] == found and len(one) == len(set(found))
    assert all(len(x) == 0 for x in divergence.distinct_terms(np.zeros(1, np.uint8), *[np.zeros(0, np.int64)] * 2))


def test_a_term_is_followed_once_however_often_it_occurs(monkeypatch):
    vocabulary = divergence.Vocabulary(divergence.Directory([("en", "dog", 2)]), {0: build([b"dog", b"the"]).to_bytes()})
    asked, follow = [], Transducer.ordinals
    monkeypatch.setattr(Transducer, "ordinals", lambda self, data, starts, *a: asked.append(len(starts)) or follow(self, data, starts, *a))
    text, ordinal = vocabulary.count(pa.array(["The dog " * 500, "the cat"]), np.zeros(2, np.int64), ["en"])
    assert sum(asked) == 3 and len(text) == 1001 and np.bincount(ordinal).tolist() == [500, 501]


def plain(rows, top=200, least=3):
    upper = {chr(c): chr(c + 32) for c in range(65, 91)}
    seen, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        terms = ["".join(upper.get(c, c) for c in t) for t in terms]
        groups.add((lang, source))
        seen[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = sorted((t for t, n in docs[lang].items() if n >= least), key=str.encode)
        def unit(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}
        p = unit(seen[lang, source])
        everywhere = sum((seen[g] for g in groups if g[0] == lang), Counter())
        q = unit(everywhere)
        pair = []
        for other in (g for g in groups if g[0] == lang and g[1] != source):
            r = unit(seen[other])
            pair.append((-sum((p[t] - r[t]) ** 2 // r[t] for t in kept), other[1].encode()))
        term = [(-((p[t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if seen[lang, source][t] and p[t] > q[t]]
        for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
            out += [(lang, source, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(items)]
    return sorted(out)


def corpus():
    rng = random.Random(9)
    terms = [t.decode() for t in words(5, 120)]
    rows = []
    for i in range(160):
        lang = ("en", "de", None)[i % 3]
        text = " ".join(rng.choice(terms[: 20 + 30 * (i % 4)]) for _ in range(rng.randint(0, 60)))
        rows.append((text.upper() if i % 7 == 0 else text, lang, f"s{rng.choice([0, 0, 0, 1, 2, 3])}"))
    rows += rows[:10] + [(None, "en", "silent"), ("", "de", None), ("x1y zé　k", "only", "one"), ("a b", "two", "p"), ("c", "two", "q")]
    rows.append(("tail " + "b" * 200_000 + " tail", "en", "long"))
    return rows + [rows[-1], rows[-1]]


SCHEMA = "text string, lang string, source string, n int, term string"


@pytest.fixture(params=["broadcast", "sent", "small blocks"])
def way(request, monkeypatch):
    if request.param != "broadcast":
        monkeypatch.setattr(divergence, "BLOCK_TERMS", 7)
    if request.param == "sent":
        monkeypatch.setattr(divergence, "BROADCAST_BYTES", 0)
    if request.param == "small blocks":
        for name, value in (("TILE_TERMS", 5), ("TILE_SOURCES", 2), ("GATHERED", 50), ("RANKED_TERMS", 3)):
            monkeypatch.setattr(divergence, name, value)


def test_audit(spark, way):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "mine") for r in rows], SCHEMA).repartition(4)
    found = sorted(map(tuple, divergence.audit(docs).collect()))
    assert found == plain(rows)
    assert any(r[2] == "term" for r in found) and any(r[0] == "" for r in found)


def test_top_and_empty(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "mine") for r in rows], SCHEMA)
    assert sorted(map(tuple, divergence.audit(docs, top=4).collect())) == plain(rows, top=4)
    assert divergence.audit(docs.limit(0)).collect() == []
