"""Bit-plane distances and clusters against plain integer arithmetic."""

import hashlib
import math

import numpy as np
import pytest

from clipcurate.llm import bitplane


@pytest.mark.parametrize("components,low,high,planes", [(64, -300, 300, 10), (64, 0, 1, 2), (70, -1, 0, 1), (3, -(2**27), 2**27 - 1, 28)])
def test_dot_products_are_exact(components, low, high, planes):
    rng = np.random.default_rng(components)
    x = rng.integers(low, high + 1 if planes > 1 else high, size=(37, components))
    y = rng.integers(low, high + 1 if planes > 1 else high, size=(5, components))
    a, b = bitplane.pack(x, planes), bitplane.pack(y, planes)
    assert a.shape == (37, planes, -(-components // 64))
    assert (bitplane.unpack(a, components) == x).all()
    assert (bitplane.dots(a, b) == x @ y.T).all()
    assert (bitplane.norms(a) == (x * x).sum(axis=1)).all()
    far = ((x[:, None] - y[None]) ** 2).sum(axis=2)
    which, distance = bitplane.nearest(a, b)
    assert (which == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


def plain(rows, k, rounds):
    """The contract in Python integers."""
    kept = []
    for vec, x in rows:
        if x is not None and len(x) == 64 and all(e is not None and math.isfinite(e) for e in x):
            kept.append((vec, [math.floor(256 * e) for e in x]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest()))
    centroids = [x for _, x in order[:k]]

    def assign():
        out = []
        for _, x in kept:
            far = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in centroids]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            members = [x for (_, x), (own, _) in zip(kept, found, strict=True) if own == c]
            if members:
                centroids[c] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    found = assign()
    total = sum(d for _, d in found)
    inertia = {c: sum(d for own, d in found if own == c) for c in range(len(centroids))}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(v), c, d, inertia[c], total, hashes[c]) for (v, _), (c, d) in zip(kept, found, strict=True))


def rows_of(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


SCHEMA = "vec_id long, embedding array<float>, cluster string, distance int"


def test_clusters(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=64) + (i % 5)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, [0.5] * 64) for i in range(60)] + [(7, rows[7][1])] * 3
    rows += [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [float("nan")] + [0.0] * 63)]
    rows += [(2004, [float("-inf")] + [0.0] * 63), (2005, [None] + [0.0] * 63), (None, [-0.001] * 64)]
    df = spark.createDataFrame([(v, x, "mine", 9) for v, x in rows], SCHEMA).repartition(5)
    assert rows_of(bitplane.cluster(df, centroids=12, rounds=4)) == plain(rows, 12, 4)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [1.0] * 64), (2, [2.0] * 64), (3, [1.0] * 64)]
    df = spark.createDataFrame([(v, x, "", 0) for v, x in rows], SCHEMA)
    assert rows_of(bitplane.cluster(df)) == plain(rows, 40, 5)
    assert bitplane.cluster(df.limit(0)).count() == 0


def test_components_too_large_are_told(spark):
    df = spark.createDataFrame([(1, [3e8] * 64, "", 0)], SCHEMA)
    with pytest.raises(OverflowError):
        bitplane.cluster(df)
