"""Document fingerprints: weighted term hashes vote on signed bits; permuted block tables find near fingerprints."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcurate.llm.common import in_ranges, map_rows, shuffle_partitions, texts_of
from clipcurate.session import written

BITS = 256
#: Fingerprints within this Hamming distance count as near in `near_counts`.
RADIUS = 6
_LANES = BITS // 64
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_SALT = np.array([0x9E3779B97F4A7C15 * (i + 1) & (1 << 64) - 1 for i in range(_LANES)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def fingerprint(text: str) -> bytes:
    """Signed votes of the word pairs of a text (of its word, if it has one only), as 256 bits.

    A pair weighs 1 + ln(occurrences). Case and white space do not count. A text without words has no votes, and
    its fingerprint is all zero.
    """
    words = text.lower().split()
    if not words:
        return bytes(BITS // 8)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(hashes) > 1:
        hashes = _mix(hashes[:-1] * np.uint64(3) + hashes[1:])
    terms, occurrences = np.unique(hashes, return_counts=True)
    weights = (1 + np.log(occurrences)).astype(np.float32)
    votes = np.zeros(BITS, np.float64)
    for start in range(0, len(terms), 4096):
        lanes = _mix(terms[start : start + 4096, None] + _SALT)
        bits = np.unpackbits(lanes.view(np.uint8), axis=1).astype(np.float32)
        votes += weights[start : start + 4096] @ bits
    return np.packbits(votes * 2 > weights.sum(dtype=np.float64)).tobytes()


def likeness(left: bytes, right: bytes) -> float:
    """The cosine that the share of differing bits stands for, 0 at least. Equal fingerprints have 1."""
    apart = (int.from_bytes(left) ^ int.from_bytes(right)).bit_count()
    return max(0.0, math.cos(math.pi * apart / BITS)) if apart else 1.0


def fingerprints(documents: DataFrame) -> DataFrame:
    """Add `fingerprint` (hexadecimal) to any table with a `text`; null counts as empty. Other columns are passed on."""
    columns = [c for c in documents.columns if c != "fingerprint"]

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([fingerprint(t).hex() for t in texts_of(batch)], pa.string())]

    return map_rows(documents.select(*columns), run, "fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by as many of the text that follows, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def with_edited(documents: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness and that to the next document.

    The next document is the one that follows by (doc_id, hash of the text), null ids first; after the last comes
    the first, which for a single document is itself. Texts are shuffled once, into ranges of doc_id; a range also
    gets the rows that follow it. Repeated rows follow each other.
    """
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = in_ranges(narrow, ["doc_id"], shuffle_partitions(documents.sparkSession))
    # Rows of one id are ordered by their texts' hashes.
    ranges = ranges.withColumn("_hash", F.xxhash64("text")).sortWithinPartitions(
        F.col("_copy") == 2, "doc_id", "_hash", "_copy"
    )
    return ranges.where(F.col("_copy") >= 0).select("doc_id", "text", "_copy").mapInArrow(_pairs, _EDITED)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before, out = None, []
    for batch in batches:
        ids, copies = batch.column("doc_id").to_pylist(), batch.column("_copy").to_pylist()
        for i, text, copy in zip(ids, texts_of(batch), copies, strict=True):
            row = (i, text, copy, fingerprint(text))
            if before is not None and before[2] == 0:
                out.append(_compared(before, row))
            before = row
        if len(out) >= 500:
            yield _batch(out)
            out = []
    if before is not None and before[2] == 0:
        out.append(_compared(before, before))
    if out:
        yield _batch(out)


def _compared(row: tuple, following: tuple) -> dict:
    i, text, _, own = row
    edited = edited_text(text, following[1])
    print_of_edited = fingerprint(edited)
    return {
        "doc_id": i,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
        "fingerprint": own.hex(),
        "edited_fingerprint": print_of_edited.hex(),
        "near_edited": likeness(own, print_of_edited),
        "near_next": likeness(own, following[3]),
    }


def _batch(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def block_tables(fingerprint: str, radius: int = RADIUS) -> Column:
    """One 64-bit key per permuted table: two of `radius` + 2 blocks, moved to the front and hashed together.

    Fingerprints that differ in up to `radius` bits agree in two blocks at least, so they share a key in a table.
    """
    digits, blocks = BITS // 4, radius + 2
    cuts = [i * digits // blocks for i in range(blocks + 1)]
    part = [F.substring(fingerprint, cuts[i] + 1, cuts[i + 1] - cuts[i]) for i in range(blocks)]
    keys = [F.xxhash64(F.lit(n), part[i], part[j]) for n, (i, j) in enumerate(combinations(range(blocks), 2))]
    return F.explode(F.array(*keys))


def within_radius(queries: DataFrame, corpus: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(query, found, distance) of distinct fingerprints within `radius` bits; both tables have a `fingerprint`.

    All are found, each pair once; equal fingerprints have distance 0. Candidates share a key in a block table;
    their number grows with the queries, not with pairs of the corpus.
    """
    asked = queries.select("fingerprint").where("fingerprint is not null").distinct()
    known = corpus.select("fingerprint").where("fingerprint is not null").distinct()
    left = asked.select(F.col("fingerprint").alias("query"), block_tables("fingerprint", radius).alias("_key"))
    right = known.select(F.col("fingerprint").alias("found"), block_tables("fingerprint", radius).alias("_key"))

    @F.arrow_udf("int")
    def apart(a: pa.Array, b: pa.Array) -> pa.Array:
        pairs = zip(a.to_pylist(), b.to_pylist(), strict=True)
        return pa.array([(int(x, 16) ^ int(y, 16)).bit_count() for x, y in pairs], pa.int32())

    near = left.join(right, "_key").select("query", "found").distinct()
    return near.withColumn("distance", apart("query", "found")).where(F.col("distance") <= radius)


def near_counts(table: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, n_near) for the fingerprints of `queries`: rows of `table` within the radius, with the row itself."""
    rows = table.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("_rows"))
    found = within_radius(queries, table, radius)
    return (
        found.join(rows.withColumnRenamed("fingerprint", "found"), "found")
        .groupBy(F.col("query").alias("fingerprint"))
        .agg(F.sum("_rows").alias("n_near"))
    )


def compare_edited(documents: DataFrame, radius: int = RADIUS, every: int = 100) -> DataFrame:
    """`with_edited`, and `n_near` for the ids divisible by `every`: the other rows within the radius. Else it is null."""
    table = written(with_edited(documents), "simhash")
    asked = F.col("doc_id") % every == 0
    counts = written(near_counts(table, table.where(asked), radius), "simhash-near")
    joined = table.join(counts, "fingerprint", "left")
    return joined.select(*table.columns, F.when(asked, F.col("n_near") - 1).alias("n_near"))
