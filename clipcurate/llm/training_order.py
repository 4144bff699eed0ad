"""Training-order materialisation: a keyed Feistel permutation gives every token sequence its global slot.

Sequences are written once as they come. A sequence's number is its place in the order of the files and their rows, so it
does not depend on how the files were split over tasks.
The permutation of the numbers is computed, not stored: a slot is found from a number, or a number from a slot, without
a table. Slots are dealt to shards by range, and a shard is one row with a payload of fixed-stride records, so slot s is
record s mod n of shard s div n, and reading can go on from any slot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipcurate.llm.bpe import parse_ranks
from clipcurate.llm.common import byte_slices, give_back, shuffle_partitions, texts_of
from clipcurate.session import scratch_path, ship_code

LENGTH = 256
PER_SHARD = 4096
KEY = b"training order"
ROUNDS = 6
PAD = 0xFFFF

_SHARD = "shard long, first_slot long, doc_ids array<long>, parts array<int>, sizes array<int>, payload binary"
_KINDS = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64())
_RUN_SHIFT = 32


class Feistel:
    """A keyed permutation of 0 to n - 1: a balanced Feistel network over the next even number of bits.

    Values that leave the range walk on along their cycle until they are back in it, which takes fewer than four
    steps on average, as the network covers less than four times the range.
    """

    def __init__(self, n: int, key: bytes, rounds: int = ROUNDS):
        self.n = n
        self.half = np.uint64(max(1, -(-max(1, (n - 1).bit_length()) // 2)))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        digests = [hashlib.blake2b(bytes([r]), key=key, digest_size=8).digest() for r in range(rounds)]
        self.keys = [np.uint64(int.from_bytes(d, "little")) for d in digests]

    def _mixed(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def _forth(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._mixed(right, key)
        return left << self.half | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in reversed(self.keys):
            left, right = right ^ self._mixed(left, key), left
        return left << self.half | right

    def _walked(self, x: np.ndarray, step) -> np.ndarray:
        x = step(np.asarray(x, np.uint64))
        while len(out := np.flatnonzero(x >= self.n)):
            x[out] = step(x[out])
        return x.astype(np.int64)

    def slots(self, numbers) -> np.ndarray:
        return self._walked(numbers, self._forth)

    def numbers(self, slots) -> np.ndarray:
        return self._walked(slots, self._back)


def _encoder(ranks: bytes, pattern: str) -> tuple[tiktoken.Encoding, int]:
    """The library's encoder and the id of the end mark."""
    parsed = parse_ranks(ranks)
    end = max(parsed.values()) + 1
    if end >= PAD:
        raise ValueError("16-bit records hold vocabularies of up to 65,534 tokens")
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=parsed, special_tokens={}), end


def sequences(
    documents: DataFrame, ranks: bytes, pattern: str, length: int = LENGTH, place: tuple[str, str] | None = None
) -> DataFrame:
    """(doc_id, part, ids, run, at) of every whole `text`: its tokens and an end mark, cut into `length` tokens each.

    The last sequence of a document is shorter. A null or empty text is its end mark alone, so no document is lost.
    `at` numbers the sequences of a run of rows, `run` is the run's number in its task, and `file` and `row` say where it
    begins. With `place`, the columns of a row's file and its number there, a run is a stretch of a file that one task
    reads; without it, all that a task reads.
    """
    ship_code(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast((ranks, pattern))
    file, row = place or (F.lit(""), F.lit(0).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, end = _encoder(*shared.value)
        end = np.array([end], "<u2")
        task = TaskContext.get().partitionId()
        number, at, here, first = -1, 0, None, 0
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                out: list[list] = [[], [], [], [], [], [], []]
                rows = zip(*[batch.column(c).to_pylist() for c in ("doc_id", "file", "row")], texts_of(batch), strict=True)
                for doc, own, line, text in rows:
                    if here != (own, line - 1):
                        if number < 0 or place:
                            number, at, first = number + 1, 0, line
                    here = (own, line)
                    ids = np.append(library.encode_to_numpy(text, disallowed_special=()).astype("<u2"), end).tobytes()
                    for part, start in enumerate(range(0, len(ids), 2 * length)):
                        values = (doc, part, ids[start : start + 2 * length], (task << _RUN_SHIFT) | number, at, own, first)
                        for column, value in zip(out, values, strict=True):
                            column.append(value)
                        at += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(out, _KINDS, strict=True)],
                    names=["doc_id", "part", "ids", "run", "at", "file", "row"],
                )
        give_back()

    narrow = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(file).alias("file") if place else file.alias("file"),
        (F.col(row) if place else row).alias("row"),
    )
    return narrow.mapInArrow(run, "doc_id long, part int, ids binary, run long, at long, file string, row long")


def materialise(
    documents: DataFrame,
    ranks: bytes,
    pattern: str,
    path: str | None = None,
    key: bytes = KEY,
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    place: tuple[str, str] | None = None,
) -> DataFrame:
    """Write the sequences of all documents in training order and return the shards as written.

    One row per shard: `shard`, `first_slot`, `payload` of records of 2 x `length` bytes (ids as little-endian unsigned
    16-bit integers, filled up with 65535), and per record the document, the part of it and the number of ids. All
    shards but the last have `per_shard` records. With `place`, the columns
    of a row's file and of its number there, the order is fixed by the key and the files; else by the key and the splits. Repeated rows and ids are sequences of their own; a null id is kept. An empty table gives no shards.
    """
    spark = documents.sparkSession
    path = path or scratch_path(spark, "training-order")
    rows = _packed(sequences(documents, ranks, pattern, length, place), scratch_path(spark, "sequences"))
    # One row per stretch of a file that one task has read.
    found = rows.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.first("file").alias("file"), F.first("row").alias("row"))
    offsets, n = {}, 0
    for r in sorted(found.collect(), key=lambda r: (r["file"], r["row"], r["run"])):
        offsets[r["run"]], n = n, n + r["n"]
    n_shards = -(-n // per_shard)
    partitions = max(1, min(n_shards, shuffle_partitions(spark)))

    @F.arrow_udf("long")
    def slot_of(run: pa.Array, at: pa.Array) -> pa.Array:
        runs, own = np.unique(np.asarray(run, np.int64), return_inverse=True)
        first = np.array([offsets[r] for r in runs.tolist()], np.int64)
        return pa.array(Feistel(n, key).slots(first[own] + np.asarray(at, np.int64)), pa.int64())

    placed = rows.select(slot_of("run", "at").alias("slot"), "doc_id", "part", "ids")
    dealt = placed.repartitionById(
        partitions, (F.floor(F.col("slot") / per_shard) * partitions / max(n_shards, 1)).cast("int")
    ).sortWithinPartitions("slot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            shard = batch.column("slot").to_numpy() // per_shard
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                if held and stop > start and held[0].column("slot")[0].as_py() // per_shard != shard[start]:
                    yield _shard_batch(held, length, per_shard)
                    held = []
                if stop > start:
                    held.append(batch.slice(start, stop - start))
        if held:
            yield _shard_batch(held, length, per_shard)

    _packed(dealt.mapInArrow(run, _SHARD), path)
    return read_shards(spark, path)


def _packed(table: DataFrame, path: str) -> DataFrame:
    """The table as written with zstd, which packs token ids and fillings closer than the default codec."""
    table.write.option("compression", "zstd").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def _shard_batch(held: list[pa.RecordBatch], length: int, per_shard: int) -> pa.RecordBatch:
    """One shard of its records, each filled up to the stride."""
    rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    ids = rows.column("ids")
    sizes = pc.binary_length(ids).to_numpy() // 2
    records = np.full((len(sizes), length), PAD, "<u2")
    records[np.arange(length) < sizes[:, None]] = np.frombuffer(b"".join(x.as_buffer() for x in ids), "<u2")
    first = rows.column("slot")[0].as_py()
    whole = pa.array([0, len(sizes)], pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([first // per_shard], pa.int64()),
            pa.array([first], pa.int64()),
            pa.ListArray.from_arrays(whole, rows.column("doc_id")),
            pa.ListArray.from_arrays(whole, rows.column("part")),
            pa.ListArray.from_arrays(whole, pa.array(sizes, pa.int32())),
            pa.array([records.tobytes()], pa.binary()),
        ],
        names=["shard", "first_slot", "doc_ids", "parts", "sizes", "payload"],
    )


def read_shards(spark: SparkSession, path: str, from_slot: int = 0, per_shard: int = PER_SHARD) -> DataFrame:
    """The shards from the one with `from_slot` on; the filter reaches the files' statistics."""
    shards = spark.read.schema(_SHARD).parquet(path)
    return shards.where(F.col("shard") >= from_slot // per_shard) if from_slot else shards


def positions(shards: DataFrame) -> DataFrame:
    """Per record: slot, shard, position in it, document, part, number of tokens, and the hash of its ids."""
    schema = "slot long, shard long, position int, doc_id long, part int, n_tokens int, ids_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                first, shard = batch.column("first_slot")[row].as_py(), batch.column("shard")[row].as_py()
                docs, parts, sizes = (batch.column(c)[row].values for c in ("doc_ids", "parts", "sizes"))
                view = memoryview(batch.column("payload")[row].as_buffer())
                count, stride = len(sizes), len(view) // len(sizes)
                digests = [
                    hashlib.sha256(view[i * stride : i * stride + 2 * size]).hexdigest()
                    for i, size in enumerate(sizes.to_pylist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(count) + first, pa.int64()),
                        pa.array(np.full(count, shard), pa.int64()),
                        pa.array(np.arange(count), pa.int32()),
                        docs,
                        parts,
                        sizes,
                        pa.array(digests, pa.string()),
                    ],
                    names=["slot", "shard", "position", "doc_id", "part", "n_tokens", "ids_sha256"],
                )

    return shards.mapInArrow(run, schema)
