"""Best-two-fit packing of token sequences into bins of a fixed capacity.

Documents of one length are interchangeable, so the bins are planned over the histogram of lengths, which has at most
`capacity` rows however many documents there are. A step of the plan fills one bin greedily, longest documents first,
then replaces its smallest document with the two unpacked ones that fill the widened gap best, and repeats the bin as
often as every step would come out the same. The plan is thus the one that bin by bin packing gives. Tasks then look
up the bin of each document by its rank within its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipcurate.llm.common import byte_slices, give_back
from clipcurate.llm.words import WordIds
from clipcurate.session import ship_code, written

CAPACITY = 2048
#: The id that ends every document.
END = 0
_END_BYTES = END.to_bytes(4, "little")
#: Ranks within a length have so many bits in the look-up key.
_RANK_BITS = 47


@dataclass(frozen=True)
class Plan:
    """Bins by length: documents of `length` with ranks from `start` on fill `each` places a bin from `bin` on.

    The places begin at `offset` in their bin. Rows are sorted by (length, start); there is one row per length in each
    kind of bin, so their number depends on the capacity alone.
    """

    length: np.ndarray
    start: np.ndarray
    each: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    bins: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bin and the offset in it of documents given by length and rank within the length."""
        keys = (self.length << _RANK_BITS) | self.start
        row = np.searchsorted(keys, (length << _RANK_BITS) | rank, side="right") - 1
        since = rank - self.start[row]
        each = self.each[row]
        return self.bin[row] + since // each, self.offset[row] + (since % each) * length


def _pair(free: np.ndarray, room: int) -> tuple[int, int]:
    """The two free lengths x >= y of the largest sum that is at most `room`, (0, 0) if there are none."""
    sizes = np.arange(len(free))
    longest = np.maximum.accumulate(np.where(free > 0, sizes, 0))
    x = np.flatnonzero(free[:room] > 0)
    if not len(x):
        return 0, 0
    rest = np.minimum(x, room - x)
    y = longest[rest]
    y = np.where((y == x) & (free[x] < 2), longest[np.maximum(x - 1, 0)], y)
    total = np.where(y > 0, x + y, 0)
    best = len(total) - 1 - int(np.argmax(total[::-1]))
    return (int(x[best]), int(y[best])) if total[best] else (0, 0)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Pack `counts` documents of each length (1 to `capacity`) by best-two-fit."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    taken = np.zeros(capacity + 1, np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    bins = 0
    while left.any():
        longest = np.maximum.accumulate(np.where(left > 0, np.arange(capacity + 1), 0))
        used: dict[int, int] = {}
        gap, size = capacity, int(longest[capacity])
        while size:
            used[size] = min(gap // size, int(left[size]))
            gap -= used[size] * size
            size = int(longest[min(gap, size - 1)])
        greedy, smallest = dict(used), min(used)
        if gap and sum(used.values()) > 1:
            free = left.copy()
            for size, n in used.items():
                free[size] -= n
            x, y = _pair(free, gap + smallest)
            if x + y > smallest:
                used[smallest] -= 1
                for size in (x, y):
                    used[size] = used.get(size, 0) + 1
                used = {size: n for size, n in used.items() if n}
        # The next bin comes out the same as long as every length has none, one or more documents left as it has now.
        times = 1 + min(
            max(0, rest - min(2, rest)) // n
            for size, n in used.items()
            for rest in [int(left[size]) - greedy.get(size, 0)]
        )
        offset = 0
        for size in sorted(used, reverse=True):
            rows.append((size, int(taken[size]), used[size], bins, offset))
            offset += size * used[size]
            taken[size] += used[size] * times
            left[size] -= used[size] * times
        bins += times
    return Plan(*(np.array(c, np.int64) for c in zip(*sorted(rows), strict=True)), bins) if rows else Plan(
        *[np.zeros(0, np.int64)] * 5, 0
    )


def pieces(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", capacity: int = CAPACITY, keep_ids: bool = True
) -> DataFrame:
    """The token pieces of `text`: id, piece, start, length, ids (little-endian), their CRC-32, and the piece's rank.

    A document's ids are those of the tokenizer with `END` behind them; only longer ones than `capacity` are cut.
    `task` and `rank` number the pieces of one length within a task. Without `keep_ids` the ids stay in the task.
    """
    ship_code(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    names = ["id", "piece", "start", "length", *(["ids"] if keep_ids else []), "ids_crc32", "task", "rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds.of(tokenizer)
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                at, number, start, size, crc, data = [], [], [], [], [], []
                for i, ids in enumerate(words.encode(batch.column("text"))):
                    coded = ids.tobytes() + _END_BYTES
                    for n, first in enumerate(range(0, len(coded), 4 * capacity)):
                        part = coded if len(coded) <= 4 * capacity else coded[first : first + 4 * capacity]
                        at.append(i)
                        number.append(n)
                        start.append(first // 4)
                        size.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if keep_ids:
                            data.append(part)
                rank = []
                for n in size:
                    rank.append(int(seen[n]))
                    seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(at, pa.int64())),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(size, pa.int64()),
                        *([pa.array(data, pa.binary())] if keep_ids else []),
                        pa.array(crc, pa.int64()),
                        pa.array([task] * len(at), pa.int32()),
                        pa.array(rank, pa.int64()),
                    ],
                    names=names,
                )
        give_back()

    texts = docs.select(F.col(id_column).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    schema = f"id {kind}, piece int, start long, length long,{' ids binary,' if keep_ids else ''} ids_crc32 long, task int, rank long"
    return texts.mapInArrow(run, schema)


def place(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add `sequence_id` and `offset` to rows with `length`, `task` and `rank`, which must be written, not computed.

    What reaches the driver is the histogram of lengths, `capacity` rows at most.
    """
    ship_code(found.sparkSession)
    counts = found.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(
        "length",
        "task",
        F.coalesce(
            F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before"),
    )
    made = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    shared = found.sparkSession.sparkContext.broadcast(made)
    rows = found.join(before, ["length", "task"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "task")
    names = [f.name for f in rows.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = shared.value.place(length, rank)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    return rows.mapInArrow(run, f"{rows._jdf.schema().toDDL()}, sequence_id long, offset long").drop("rank")


def pack(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", capacity: int = CAPACITY, keep_ids: bool = True
) -> DataFrame:
    """Pack the tokens of all documents into sequences of at most `capacity`.

    Returns one row per piece: `id`, `piece`, `start`, `length`, `ids` (little-endian unsigned 32-bit), `ids_crc32`,
    `sequence_id` from 0 without gaps, and `offset` in the sequence, without gaps from 0. A null text is an empty one,
    whose only token is `END`; a null id stays; repeated rows are packed each for itself; an empty table gives no rows.
    Which of the documents of one length goes to which bin follows the tasks that read them; the bins do not. Other
    columns of the input, whatever their names, are not read. Without `keep_ids` only the narrow columns are written
    and shuffled, which is a plan of the packing.
    """
    return place(written(pieces(docs, tokenizer, id_column, capacity, keep_ids), "pieces"), capacity)
