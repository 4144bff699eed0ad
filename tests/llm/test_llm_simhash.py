"""Fingerprints, the edited text rule and the search within a radius, each against its plain form."""

import hashlib
import random

from clipcurate.llm import simhash as sh


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(n))


def test_fingerprint_follows_likeness():
    rnd = random.Random(1)
    for _ in range(20):
        a, b = words(rnd, 300), words(rnd, 300)
        near = a.replace(a.split()[7], "other")
        same, half, apart = (sh.likeness(sh.fingerprint(a), sh.fingerprint(x)) for x in (near, a[:900] + b[:900], b))
        assert same > 0.9 > half > apart
    assert sh.fingerprint("A  b\nc") == sh.fingerprint("a B C")
    assert sh.fingerprint(" ") == bytes(32)


def test_edited_texts_on_any_number_of_partitions(spark):
    rnd = random.Random(2)
    rows = [(i * 3, words(rnd, rnd.randint(0, 40))) for i in range(57)] + [(None, "first"), (5, None), (7, "dup"), (7, "dup")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ordered = sorted(((i is not None, i or 0), t or "") for i, t in rows)
    expected = []
    for k, (key, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        expected.append((key[1] if key[0] else None, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "4", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = [(r.doc_id, r.n_chars, r.edited_sha256) for r in sh.compare_edited(docs).collect()]
            assert sorted(got, key=str) == sorted(expected, key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sh.with_edited(docs.limit(0)).count() == 0
    one = sh.with_edited(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def test_search_finds_all_within_the_radius(spark):
    rnd = random.Random(3)
    prints = []
    for _ in range(40):
        base = rnd.getrandbits(256)
        for flips in (0, 1, 3, 6, 7, 12):
            value = base
            for bit in rnd.sample(range(256), flips):
                value ^= 1 << bit
            prints.append(f"{value:064x}")
    table = spark.createDataFrame([(p,) for p in [*prints, prints[0], None]], "fingerprint string")
    queries = table.limit(100)
    got = {(r.query, r.found, r.distance) for r in sh.within_radius(queries, table).collect()}
    asked = {r.fingerprint for r in queries.collect()}
    expected = {
        (a, b, d) for a in asked for b in set(prints) if (d := (int(a, 16) ^ int(b, 16)).bit_count()) <= sh.RADIUS
    }
    assert got == expected
