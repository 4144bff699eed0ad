"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import bisect
import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipcurate.session import ship_code

FOLDS = 3
HELD_OUT_FOLD = 1
#: Rows that a task turns into Python objects at once. Results do not depend on it.
ROWS_AT_ONCE = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """The fold of a document; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    """True for documents that no model may learn from. A null id is not held out, but never learnt from either."""
    return F.coalesce(fold(doc_id) == HELD_OUT_FOLD, F.lit(False))


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    rows: int,
    max_chars: int,
    id_column: str = "doc_id",
    seed: int = 17,
) -> list[tuple[str, object]]:
    """Up to `rows` (text, label) pairs of each label value, taken in the order of a hash of the id.

    Only rows outside the held-out fold with a non-null label and a text of 1 to `max_chars` characters are
    eligible, so what reaches the driver is bounded by rows x max_chars x number of label values. The ids are
    chosen from narrow rows first; only the chosen rows bring their texts.
    """
    wanted = labels.select(F.col(id_column).alias("_id"), F.col(label).alias("_label")).where(
        F.col("_label").isNotNull() & (fold(F.col("_id")) != HELD_OUT_FOLD)
    )
    sizes = documents.select(F.col(id_column).alias("_id"), F.length("text").alias("_n")).where(
        F.col("_n").between(1, max_chars)
    )
    eligible = wanted.join(sizes, "_id", "left_semi").distinct()
    order = F.xxhash64(F.col("_id").cast("string"), F.lit(seed))
    values = [r[0] for r in eligible.select("_label").distinct().orderBy("_label").collect()]
    chosen = [
        (r[0], value)
        for value in values
        for r in eligible.where(F.col("_label") == F.lit(value)).orderBy(order, "_id").limit(rows).collect()
    ]
    if not chosen:
        return []
    spark = documents.sparkSession
    kind = dict(eligible.dtypes)
    ids = spark.createDataFrame(chosen, f"_id {kind['_id']}, _label {kind['_label']}")
    texts = documents.select(F.col(id_column).alias("_id"), "text").where(F.length("text").between(1, max_chars))
    found = texts.join(F.broadcast(ids), "_id").select("_id", "text", "_label").distinct().collect()
    return [(r[1], r[2]) for r in sorted(found, key=lambda r: (str(r[0]), str(r[2]), r[1]))]


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch, nulls as empty texts."""
    return [x or "" for x in batch.column(name).to_pylist()]


#: Bytes of text that a task turns into Python objects at once, unless a single text is longer.
BYTES_AT_ONCE = 8 << 20


def byte_slices(batch: pa.RecordBatch, name: str, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of at most `most` bytes in a string column, or of one row. Nulls have no bytes."""
    most = most or BYTES_AT_ONCE
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, before = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])


def keeping(documents: DataFrame, taken: tuple[str, ...], function) -> DataFrame:
    """`function(documents)`, a filter that makes columns of the `taken` names on its way.

    Columns of the input that have these names, in any case, stand aside meanwhile and come out as they went in.
    """
    aside = {c: f"_own_{i}_{c}" for i, c in enumerate(documents.columns) if c.lower() in taken}
    found = function(documents.withColumnsRenamed(aside))
    return found.withColumnsRenamed({there: here for here, there in aside.items()})


_kept: dict = {}


def remembered(key, make):
    """What a worker process keeps from one task to the next: one thing, that of the operator that asked last."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def clear_worker() -> None:
    """Forget what another operator has kept in this worker, and what the last task left behind."""
    _kept.clear()
    give_back()


def give_back() -> None:
    """Return free memory to the system at the end of a task, as its worker goes on to other operators."""
    pa.default_memory_pool().release_unused()
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def map_rows(df: DataFrame, function, added: str, keeps: bool = False) -> DataFrame:
    """`function(batch) -> list of arrays` gives the columns of `added` beside the batch's own.

    Batches are cut to `ROWS_AT_ONCE` rows, and a task gives free memory back when it ends, as its worker goes on to
    other operators. `keeps`: the function goes on with what it has `remembered` in the tasks before.
    """
    ship_code(df.sparkSession)
    schema = T.StructType(df.schema.fields + T._parse_datatype_string(added).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            clear_worker()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                arrays = function(batch)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *arrays], names=[*batch.schema.names, *(f.name for f in schema.fields[-len(arrays) :])]
                )
        give_back()

    return df.mapInArrow(run, schema)


def in_ranges(df: DataFrame, key: list[str], buckets: int, seed: int = 23) -> DataFrame:
    """Sort rows into ranges that also see their neighbours: adds `_bucket` and `_copy`, one bucket per partition.

    Rows are dealt to `buckets` ranges of the key columns, whose limits come from a bounded sample of 20 keys per
    bucket, and sorted by the key inside. What follows a range is given to it as well: the rows with the first key
    of the next range, with `_copy` 1, or with the first key of all for the last range, with `_copy` 2, which sort
    last. The rows with the last key of the range before come first, with `_copy` -1. Null key parts sort first.
    A range does not depend on the number of buckets beyond its limits, so neighbours are the same for any number.
    """
    ship_code(df.sparkSession)
    keys = df.select(*key)
    order = F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key], F.lit(seed))
    sample = sorted(_plain(r) for r in keys.orderBy(order, *key).limit(20 * buckets).collect())
    splits = sorted({sample[i * len(sample) // buckets] for i in range(1, buckets)}) if sample else []
    # The first and the last key of each range: one row per range.
    ends = (
        keys.select(_bucket_of(splits)(*[F.col(k) for k in key]).alias("_bucket"), F.struct(*key).alias("_key"))
        .groupBy("_bucket")
        .agg(F.min("_key").alias("_first"), F.max("_key").alias("_last"))
        .collect()
    )
    ranges = sorted((r["_bucket"], _plain(r["_first"]), _plain(r["_last"])) for r in ends)
    also: dict[tuple, list[tuple[int, int]]] = {}
    for i, (bucket, first, last) in enumerate(ranges):
        also.setdefault(first, []).append((ranges[i - 1][0], 2 if i == 0 else 1))
        if i + 1 < len(ranges):
            also.setdefault(last, []).append((ranges[i + 1][0], -1))
    dealt = df.withColumn("_to", F.explode(_targets_of(splits, also)(*[F.col(k) for k in key]))).select(
        *df.columns, F.col("_to._bucket").alias("_bucket"), F.col("_to._copy").alias("_copy")
    )
    return dealt.repartitionById(buckets, F.col("_bucket")).sortWithinPartitions(F.col("_copy") == 2, *key, "_copy")


def _plain(parts) -> tuple:
    """A key that sorts nulls first, as Spark does."""
    return tuple((x is not None, x if x is not None else 0) for x in parts)


def _bucket_of(splits: list[tuple]):
    @F.arrow_udf("int")
    def bucket(*columns: pa.Array) -> pa.Array:
        rows = zip(*[c.to_pylist() for c in columns], strict=True)
        return pa.array([bisect.bisect_right(splits, _plain(r)) for r in rows], pa.int32())

    return bucket


def _targets_of(splits: list[tuple], also: dict[tuple, list[tuple[int, int]]]):
    kind = pa.list_(pa.struct([("_bucket", pa.int32()), ("_copy", pa.int32())]))

    @F.arrow_udf("array<struct<_bucket:int,_copy:int>>")
    def targets(*columns: pa.Array) -> pa.Array:
        out = []
        for r in zip(*[c.to_pylist() for c in columns], strict=True):
            key = _plain(r)
            places = [(bisect.bisect_right(splits, key), 0), *also.get(key, ())]
            out.append([{"_bucket": b, "_copy": c} for b, c in places])
        return pa.array(out, kind)

    return targets


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
