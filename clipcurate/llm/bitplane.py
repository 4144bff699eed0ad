"""Centroid clustering of integer vectors by popcounts of their bit planes.

A vector of integers is held as bit planes in two's complement: plane b has bit b of every component, 64 components to
an unsigned word. With the weights 2^b, and -2^b for the highest plane, the dot product of x and y is the sum over all
pairs of planes of w_a w_b popcount(x_a AND y_b). All distances come from that sum, so they are exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcurate.session import ship_code, written

COMPONENTS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
#: Components of more bits, sign included, could give distances beyond 64 bits.
MOST_BITS = 28
#: Vectors whose distances a task holds at once.
VECTORS_AT_ONCE = 2_048


def weights(planes: int) -> list[int]:
    return [1 << b for b in range(planes - 1)] + [-(1 << (planes - 1))]


def pack(values: np.ndarray, planes: int) -> np.ndarray:
    """Integers (n, components) as planes (n, planes, words)."""
    n, components = values.shape
    words = -(-components // 64)
    bits = np.zeros((n, planes, words * 64), np.uint8)
    for b in range(planes):
        bits[:, b, :components] = (values >> b) & 1
    return np.packbits(bits, axis=2, bitorder="little").view("<u8")


def unpack(planes: np.ndarray, components: int) -> np.ndarray:
    """The integers (n, components) of planes (n, planes, words)."""
    n, count, words = planes.shape
    bits = np.unpackbits(np.ascontiguousarray(planes, "<u8").view(np.uint8), axis=2, bitorder="little")[:, :, :components]
    values = np.zeros((n, components), np.int64)
    for b, w in enumerate(weights(count)):
        values += bits[:, b].astype(np.int64) * w
    return values


def dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact dot products (n, k) of packed vectors (n, planes, words) and (k, planes, words)."""
    out = np.zeros((len(x), len(y)), np.int64)
    for a, wa in enumerate(weights(x.shape[1])):
        for b, wb in enumerate(weights(y.shape[1])):
            for word in range(x.shape[2]):
                shared = np.bitwise_count(x[:, a, word][:, None] & y[:, b, word][None, :])
                out += shared.astype(np.int64) * (wa * wb)
    return out


def norms(x: np.ndarray) -> np.ndarray:
    """Exact squared lengths (n) of packed vectors."""
    out = np.zeros(len(x), np.int64)
    wx = weights(x.shape[1])
    for a, wa in enumerate(wx):
        for b, wb in enumerate(wx):
            out += np.bitwise_count(x[:, a] & x[:, b]).sum(axis=1, dtype=np.int64) * (wa * wb)
    return out


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest centroid and the squared distance to it; ties go to the smaller number."""
    lengths, own = norms(x), norms(centroids)
    which, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    for start in range(0, len(x), VECTORS_AT_ONCE):
        part = slice(start, start + VECTORS_AT_ONCE)
        far = lengths[part, None] - 2 * dots(x[part], centroids) + own[None, :]
        which[part] = far.argmin(axis=1)
        distance[part] = far.min(axis=1)
    return which, distance


def _finite(vector: Column, components: int) -> Column:
    """True for vectors of so many components, all of them finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == components) & ~odd, F.lit(False))


def _planes_of(column: pa.Array, shape: tuple[int, int]) -> np.ndarray:
    """The packed vectors of a column of fixed-size binary values."""
    data = b"".join(x.as_buffer() for x in column)
    return np.frombuffer(data, "<u8").reshape(-1, *shape)


def _packed(vectors: DataFrame, planes: int, components: int, scale: int) -> DataFrame:
    """Each kept vector's `id` and `planes`."""
    kind = vectors.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            values = np.floor(scale * flat).astype(np.int64).reshape(-1, components)
            data = [row.tobytes() for row in pack(values, planes)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(data, pa.binary())], names=["id", "planes"])

    return vectors.select("id", "vector").mapInArrow(run, f"id {kind}, planes binary")


def _first(packed: DataFrame, centroids: int, seed: str, shape: tuple[int, int]) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in the order of the hashes."""
    key = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"), 256)
    rows = packed.orderBy(key.asc_nulls_last(), "planes").limit(centroids).collect()
    return np.frombuffer(b"".join(bytes(r["planes"]) for r in rows), "<u8").reshape(-1, *shape)


def _sums(packed: DataFrame, centroids: np.ndarray, components: int) -> list[tuple[int, int, list[int]]]:
    """(centroid, vectors, componentwise sums) of the vectors nearest to each centroid; each task sends one row apiece."""
    shape = centroids.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros((len(centroids), components), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _planes_of(batch.column("planes"), shape)
            which, _ = nearest(x, centroids)
            order = np.argsort(which, kind="stable")
            starts = np.flatnonzero(np.diff(which[order], prepend=-1))
            found = which[order][starts]
            total[found] += np.add.reduceat(unpack(x, components)[order], starts, axis=0)
            count += np.bincount(which, minlength=len(centroids))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, components), pa.int32()),
                pa.array(np.tile(np.arange(components), len(used)), pa.int32()),
                pa.array(np.repeat(count[used], components), pa.int64()),
                pa.array(total[used].ravel(), pa.int64()),
            ],
            names=["centroid", "component", "n", "total"],
        )

    parts = packed.mapInArrow(run, "centroid int, component int, n long, total long")
    rows = parts.groupBy("centroid", "component").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("t"))
    found: dict[int, tuple[int, list[int]]] = {}
    for r in rows.collect():
        found.setdefault(r["centroid"], (r["n"], [0] * components))[1][r["component"]] = int(r["t"])
    return [(c, n, sums) for c, (n, sums) in found.items()]


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: str = "2:",
) -> DataFrame:
    """Lloyd's rounds over vectors of integers floor(scale * x), with exact distances and exact floored means.

    Returns one row per vector of `components` finite numbers: the id, `cluster`, `distance` (squared), the sums of
    distances over the cluster and over all, and `centroid_sha256`. Vectors of another size and those with a null, NaN
    or infinite component, or null themselves, are left out. The first centroids are the vectors with the smallest
    sha256 of `seed` and id; equal ids, and null ids, which come last, are told apart by their components. With fewer
    vectors than centroids each is one; an empty table gives no rows; repeated rows count each for itself. Components
    beyond `MOST_BITS` bits raise an OverflowError, as distances would leave 64 bits. Other columns are not read.
    What the driver holds is one row per centroid.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    kept = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector")).where(
        _finite(F.col("vector"), components)
    )
    least, most = kept.agg(F.min(F.array_min("vector")), F.max(F.array_max("vector"))).first()
    ends = [math.floor(scale * x) for x in (least, most) if x is not None]
    planes = 1 + max([e.bit_length() if e >= 0 else (~e).bit_length() for e in ends], default=0)
    if planes > MOST_BITS:
        raise OverflowError(f"components of {planes} bits give distances beyond 64 bits")
    shape = (planes, -(-components // 64))
    packed = written(_packed(kept, planes, components, scale), "bit-planes")
    now = _first(packed, centroids, seed, shape)
    for _ in range(rounds if len(now) else 0):
        values = unpack(now, components)
        for c, n, sums in _sums(packed, now, components):
            values[c] = [s // n for s in sums]
        now = pack(values, planes)
    kind = packed.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                which, distance = nearest(_planes_of(batch.column("planes"), shape), now)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(which, pa.int32()), pa.array(distance, pa.int64())],
                    names=["id", "cluster", "distance"],
                )

    found = written(packed.mapInArrow(run, f"id {kind}, cluster int, distance long"), "clusters")
    hashes = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(unpack(now, components).tolist())]
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    totals = {r["cluster"]: r["cluster_inertia"] for r in sums.collect()}
    about = spark.createDataFrame(
        [(c, totals[c], sum(totals.values()), h) for c, h in hashes if c in totals],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(about), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
