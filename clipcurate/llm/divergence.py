"""How far the sources of a language diverge in their use of its frequent terms.

The kept terms of a language are numbered in byte order by minimal acyclic transducers, one for each block of terms.
The texts are streamed through them for counting, so only (group, number, count) rows are shuffled, and numbers break
ties as the terms would. All arithmetic is in integers.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipcurate.llm.common import byte_slices, give_back, shuffle_partitions
from clipcurate.llm.transducer import LONG_BYTES, Transducer, build
from clipcurate.session import ship_code, written

#: Texts in which a term has to occur to be kept, and the terms that are reported of each group.
LEAST_TEXTS = 3
TOP_TERMS = 200
#: Terms and bytes of a block, which is built and held as one transducer.
BLOCK_TERMS = 100_000
BLOCK_BYTES = 16 << 20
#: Transducers of up to this many bytes in all are broadcast; with more, counted terms are sent to their blocks.
BROADCAST_BYTES = 64 << 20
#: Entries that a task gathers before it passes them on.
GATHERED = 400_000
#: Sources and terms of a tile of the comparison of sources.
TILE_SOURCES = 128
TILE_TERMS = 4_096
#: Parts into which the counted terms of one block are split, and the terms of one group are ranked.
SALTS = 8
RANKED_TERMS = 1 << 16
UNIT = 1_000_000_000
# The sides of a tile that a source is on; in the tile of its own block it is on both.
_BOTH, _LEFT, _RIGHT = 0, 1, 2
_LOWER = np.array([b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 0 for b in range(256)], np.uint8)
# Masks of the first n of eight bytes.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def probability(occurrences: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(UNIT * occurrences / total), for occurrences up to a total below 2^63 / 1000, by long division."""
    quotient, rest = np.divmod(occurrences, total)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        quotient = quotient * 1000 + more
    return quotient + 1


def _strings(items: list[bytes]) -> pa.Array:
    return pa.array(items, pa.binary()).cast(pa.string())


def _counted(docs: DataFrame, by_source: bool) -> DataFrame:
    """Partial counts by task: texts in which a term occurs by language, or its occurrences by language and source."""
    names = ["lang", "source", "term", "n"] if by_source else ["lang", "term", "n"]

    def flush(found: dict[tuple, Counter]) -> Iterator[pa.RecordBatch]:
        for key, terms in found.items():
            columns = [pa.repeat(pa.scalar(k, pa.string()), len(terms)) for k in key]
            yield pa.RecordBatch.from_arrays(
                [*columns, _strings(list(terms)), pa.array(terms.values(), pa.int64())], names=names
            )
        found.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, Counter] = {}
        for whole in batches:
            for batch in byte_slices(whole, "text"):
                keys = list(zip(*[batch.column(c).to_pylist() for c in names[:-2]], strict=True))
                numbers = {key: i for i, key in enumerate(dict.fromkeys(keys))}
                group = np.array([numbers[key] for key in keys], np.int64)
                low, text, starts, lengths = occurrences(batch.column("text"))
                one, term = distinct_terms(low, starts, lengths)
                if not by_source and len(one):
                    text, term = np.divmod(np.unique(text * len(one) + term), len(one))
                pairs, n = np.unique(group[text] * len(one) + term, return_counts=True)
                limits = np.searchsorted(pairs, np.arange(len(numbers) + 1) * len(one))
                data = low.tobytes()
                spelled = [data[i : i + k] for i, k in zip(starts[one].tolist(), lengths[one].tolist(), strict=True)]
                for key, i in numbers.items():
                    terms, own = found.setdefault(key, Counter()), slice(limits[i], limits[i + 1])
                    for t, more in zip((pairs[own] - i * len(one)).tolist(), n[own].tolist(), strict=True):
                        terms[spelled[t]] = terms.get(spelled[t], 0) + more
                if sum(map(len, found.values())) > GATHERED:
                    yield from flush(found)
        yield from flush(found)
        give_back()

    kinds = {"n": "long"}
    parts = docs.mapInArrow(run, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in names))
    return parts.groupBy(*names[:-1]).agg(F.sum("n").alias("n"))


def kept_terms(docs: DataFrame, least: int = LEAST_TEXTS) -> DataFrame:
    """(lang, term) of the terms that occur in at least `least` texts of the language."""
    return _counted(docs, False).where(F.col("n") >= least).select("lang", "term")


def blocks_of(terms: DataFrame) -> DataFrame:
    """Transducers over ranges of the sorted (lang, term): lang, first term, number of terms, and their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[bytes] = []
        lang, size = None, 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lang], pa.string()),
                    _strings(block[:1]),
                    pa.array([len(block)], pa.int64()),
                    pa.array([build(block).to_bytes()], pa.binary()),
                ],
                names=["lang", "first", "n", "data"],
            )

        for batch in batches:
            rows = zip(batch.column("lang").to_pylist(), batch.column("term").cast(pa.binary()).to_pylist(), strict=True)
            for own, term in rows:
                if block and (own != lang or len(block) >= BLOCK_TERMS or size >= BLOCK_BYTES):
                    yield done()
                    block, size = [], 0
                lang = own
                block.append(term)
                size += len(term)
        if block:
            yield done()

    ranges = 1 + terms.count() // BLOCK_TERMS
    ranged = terms.repartitionByRange(ranges, "lang", "term").sortWithinPartitions("lang", "term")
    return ranged.mapInArrow(run, "lang string, first string, n long, data binary")


def occurrences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes of all texts, and the text, start and length of every occurrence of a term in them."""
    texts = texts.cast(pa.large_string())
    nothing = np.zeros(0, np.int64)
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), nothing, nothing, nothing
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]]
    if not len(low):
        return low, nothing, nothing, nothing
    ends = ends - ends[0]
    inside = low > 0
    after, before = np.append(inside[1:], False), np.append(False, inside[:-1])
    cuts = ends[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(low))]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    return low, np.searchsorted(ends[1:], starts, side="right"), starts, lengths


def distinct_terms(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One occurrence of each distinct term, and the number of its term for every occurrence.

    Terms are told apart exactly, by eight bytes at a time; no byte of a term is 0, so shorter ones are filled up.
    """
    eights = np.ndarray(len(low) + 1, "<u8", np.append(low, np.zeros(8, np.uint8)), strides=(1,))
    term, numbers = np.zeros(len(starts), np.int64), 1
    left, step = np.flatnonzero(lengths <= LONG_BYTES), 0
    while len(left):
        word = eights[starts[left] + step] & _FIRST_BYTES[np.minimum(lengths[left] - step, 8)]
        words = pa.array(word).dictionary_encode()
        if step:
            both = term[left] * len(words.dictionary) + words.indices.to_numpy()
            words = pa.array(both).dictionary_encode()
        term[left] = numbers + words.indices.to_numpy().astype(np.int64)
        numbers += len(words.dictionary)
        step += 8
        left = left[lengths[left] > step]
    long: dict[bytes, int] = {}
    for i in np.flatnonzero(lengths > LONG_BYTES):
        term[i] = long.setdefault(low[starts[i] : starts[i] + lengths[i]].tobytes(), numbers + len(long))
    one = np.full(numbers + len(long), -1, np.int64)
    one[term] = np.arange(len(term))
    used = one >= 0
    return one[used], (np.cumsum(used) - 1)[term]


class Directory:
    """Where the blocks of each language begin: one entry for each block."""

    def __init__(self, rows: list[tuple[str, str, int]]):
        self.of: dict[str, tuple[list[bytes], list[int], list[int]]] = {}
        for number, (lang, first, n) in enumerate(sorted((lang, first.encode(), n) for lang, first, n in rows)):
            firsts, bases, numbers = self.of.setdefault(lang, ([], [], []))
            bases.append(bases[-1] + self._last if bases else 0)
            self._last = n
            firsts.append(first)
            numbers.append(number)

    def by_term(self, lang: str, term: bytes) -> int:
        """The block in which a term would be."""
        firsts, _, numbers = self.of.get(lang, ([], [], []))
        at = bisect.bisect_right(firsts, term) - 1
        return numbers[at] if at >= 0 else -1

    def by_ordinal(self, lang: str, ordinal: int) -> int:
        _, bases, numbers = self.of[lang]
        return numbers[bisect.bisect_right(bases, ordinal) - 1]

    def bases(self) -> dict[int, int]:
        return {n: b for _, bases, numbers in self.of.values() for n, b in zip(numbers, bases, strict=True)}


class Vocabulary:
    """All transducers as one, for streaming texts through it."""

    def __init__(self, directory: Directory, data: dict[int, bytes]):
        self.directory = directory
        self.arcs, self.roots = Transducer.together([Transducer.from_bytes(data[i]) for i in range(len(data))])
        bases = directory.bases()
        self.bases = np.array([bases[i] for i in range(len(data))], np.int64)
        self.prefixes = {
            lang: np.array([int.from_bytes(f[:8].ljust(8, b"\0"), "big") for f in firsts], np.uint64)
            for lang, (firsts, _, _) in directory.of.items()
        }

    def _blocks(self, lang: str, low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The block of each term, -1 for none. Eight bytes decide, unless they are those of a block's first term."""
        if lang not in self.prefixes:
            return np.full(len(starts), -1, np.int64)
        numbers, firsts = np.array(self.directory.of[lang][2]), self.prefixes[lang]
        if len(numbers) == 1:
            return np.full(len(starts), numbers[0], np.int64)
        prefix = np.zeros(len(starts), np.uint64)
        for k in range(8):
            inside = lengths > k
            prefix <<= np.uint64(8)
            prefix[inside] |= low[starts[inside] + k]
        at = np.searchsorted(firsts, prefix, side="right") - 1
        found = np.where(at >= 0, numbers[at], -1)
        for i in np.flatnonzero((at >= 0) & (firsts[at] == prefix)):
            found[i] = self.directory.by_term(lang, low[starts[i] : starts[i] + lengths[i]].tobytes())
        return found

    def count(self, texts: pa.Array, langs: np.ndarray, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, ordinal) of every occurrence of a kept term; `langs` gives each text's place in `names`."""
        low, text, starts, lengths = occurrences(texts)
        lang = langs[text]
        ordinal = np.full(len(starts), -1, np.int64)
        for i in np.unique(lang):
            own = np.flatnonzero(lang == i)
            # A term that occurs often is followed once.
            one, term = distinct_terms(low, starts[own], lengths[own])
            at, long = starts[own[one]], lengths[own[one]]
            block = self._blocks(names[i], low, at, long)
            known = block >= 0
            found = np.full(len(one), -1, np.int64)
            places = self.arcs.ordinals(low, at[known], long[known], self.roots[block[known]])
            found[known] = np.where(places >= 0, places + self.bases[block[known]], -1)
            ordinal[own] = found[term]
        kept = ordinal >= 0
        return text[kept], ordinal[kept]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(at, counts, len(distinct)).astype(np.int64)


def _streamed(docs: DataFrame, directory: Directory, data: dict[int, bytes]) -> DataFrame:
    """(lang, source, ordinal, n), with the texts streamed through the transducers of all languages."""
    shared = docs.sparkSession.sparkContext.broadcast((directory, data))
    shift = 40

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*shared.value)
        groups: dict[tuple[str, str], int] = {}
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def flush() -> pa.RecordBatch:
            names = list(groups)
            group = pa.array(keys >> shift, pa.int64())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([g[0] for g in names], pa.string()).take(group),
                    pa.array([g[1] for g in names], pa.string()).take(group),
                    pa.array(keys & ((1 << shift) - 1), pa.int64()),
                    pa.array(counts, pa.int64()),
                ],
                names=["lang", "source", "ordinal", "n"],
            )

        for whole in batches:
            for batch in byte_slices(whole, "text"):
                lang = batch.column("lang").dictionary_encode()
                pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
                group = np.array([groups.setdefault(p, len(groups)) for p in pairs], np.int64)
                text, ordinal = vocabulary.count(batch.column("text"), lang.indices.to_numpy(), lang.dictionary.to_pylist())
                more, n = np.unique((group[text] << shift) | ordinal, return_counts=True)
                keys, counts = _summed(np.append(keys, more), np.append(counts, n))
                if len(keys) > GATHERED:
                    yield flush()
                    groups, keys, counts = {}, keys[:0], counts[:0]
        yield flush()
        give_back()

    parts = docs.mapInArrow(run, "lang string, source string, ordinal long, n long")
    return parts.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def _meet(blocks: DataFrame, rows: DataFrame, salt: Column, function, schema: str) -> DataFrame:
    """`function(transducer, base, batch)` over rows with `block`, streamed behind the transducer of their block.

    The rows of a block are split by `salt`; the block goes to each part. Nothing is grouped in memory.
    """
    names = rows.columns
    salted = rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int")).withColumn("_data", F.lit(None).cast("binary"))
    salted = salted.withColumn("_base", F.lit(None).cast("long"))
    here = blocks.select(
        F.col("block"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"), F.col("data").alias("_data"),
        F.col("base").alias("_base"),
    )
    both = salted.unionByName(here, allowMissingColumns=True)
    dealt = both.repartition(shuffle_partitions(rows.sparkSession), "block", "_salt")
    order = dealt.sortWithinPartitions("block", "_salt", F.col("_data").isNull()).select(*names, "_data", "_base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            marks = np.flatnonzero(pc.is_valid(batch.column("_data")).to_numpy(zero_copy_only=False)).tolist()
            for start, stop in zip([0, *[m + 1 for m in marks]], [*marks, batch.num_rows], strict=True):
                if start:
                    now = batch.column("_data")[start - 1].as_py(), batch.column("_base")[start - 1].as_py()
                    now = Transducer.from_bytes(now[0]), now[1]
                if stop > start:
                    yield function(*now, batch.slice(start, stop - start))

    return order.mapInArrow(run, schema)


def _sent(docs: DataFrame, terms: DataFrame, blocks: DataFrame, directory: Directory) -> DataFrame:
    """(lang, source, ordinal, n), with counted terms sent to their blocks and through the transducers there."""

    @F.arrow_udf("int")
    def block_of(lang: pa.Array, term: pa.Array) -> pa.Array:
        pairs = zip(lang.to_pylist(), term.cast(pa.binary()).to_pylist(), strict=True)
        return pa.array([directory.by_term(*p) for p in pairs], pa.int32())

    def number(arcs: Transducer, base: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("term").to_pylist()
        data = [t.encode() for t in texts]
        lengths = np.array([len(x) for x in data], np.int64)
        found = arcs.ordinals(np.frombuffer(b"".join(data), np.uint8), np.cumsum(lengths) - lengths, lengths)
        kept = pa.array(np.flatnonzero(found >= 0))
        return pa.RecordBatch.from_arrays(
            [batch.column("lang").take(kept), batch.column("source").take(kept), pa.array(found[found >= 0] + base), batch.column("n").take(kept)],
            names=["lang", "source", "ordinal", "n"],
        )

    counted = _counted(docs, True).join(terms, ["lang", "term"], "left_semi")
    rows = counted.withColumn("block", block_of(F.col("lang"), F.col("term")))
    return _meet(blocks, rows, F.xxhash64("source", "term"), number, "lang string, source string, ordinal long, n long")


def _pair_values(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, item, value): f summed over all kept terms for every ordered pair of sources of a language.

    The terms and sources of a language are cut into tiles of fixed size, and a tile sums the pairs of its sources over
    its terms. Every source puts its number of occurrences at the head of its tiles, so one without terms is there.
    """
    blocks = F.ceil(F.col("sources") / TILE_SOURCES).cast("int")
    own = F.floor((F.col("number") - 1) / TILE_SOURCES).cast("int")

    def place(i: Column, j: Column, side: int) -> Column:
        return F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))

    places = F.flatten(
        F.transform(
            F.sequence(F.lit(0), blocks - 1),
            lambda other: F.when(other == own, F.array(place(own, own, _BOTH))).otherwise(
                F.array(place(own, other, _LEFT), place(other, own, _RIGHT))
            ),
        )
    )
    tiles = F.greatest(F.ceil(F.col("terms") / TILE_TERMS).cast("int"), F.lit(1))
    heads = groups.withColumn("tile", F.explode(F.sequence(F.lit(0), tiles - 1))).select(
        "lang", "tile", F.explode(places).alias("p"), "number", F.lit(-1).cast("long").alias("ordinal"),
        F.col("total").alias("n"), "terms",
    )
    body = counts.select(
        "lang", F.floor(F.col("ordinal") / TILE_TERMS).cast("int").alias("tile"), F.explode(places).alias("p"), "number",
        "ordinal", "n", "terms",
    )
    rows = heads.unionByName(body).select("lang", "tile", "p.i", "p.j", "p.side", "number", "ordinal", "n", "terms")

    def sums(key: tuple, table: pa.Table) -> pa.Table:
        lang, tile, i, j = (k.as_py() for k in key)
        sides, number, ordinal, n = (table.column(c).to_numpy() for c in ("side", "number", "ordinal", "n"))
        terms = table.column("terms")[0].as_py()
        width = min(TILE_TERMS, terms - tile * TILE_TERMS)

        def side(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            head = own & (ordinal < 0)
            order = np.argsort(number[head])
            names, totals = number[head][order], n[head][order]
            seen = np.zeros((len(names), width), np.int64)
            body = own & (ordinal >= 0)
            seen[np.searchsorted(names, number[body]), ordinal[body] - tile * TILE_TERMS] = n[body]
            return names, probability(seen + 1, (totals + terms)[:, None]) if width else seen

        (a, p), (b, q) = side(sides != _RIGHT), side(sides != _LEFT)
        value = np.array([((row - q) ** 2 // q).sum(axis=1) for row in p]) if width else np.zeros((len(a), len(b)), np.int64)
        one, two = np.repeat(a, len(b)), np.tile(b, len(a))
        apart = one != two
        return pa.table({
            "lang": pa.array([lang] * int(apart.sum()), pa.string()), "number": pa.array(one[apart], pa.int32()),
            "other": pa.array(two[apart], pa.int32()), "value": pa.array(value.ravel()[apart], pa.int64()),
        })

    parts = rows.groupBy("lang", "tile", "i", "j").applyInArrow(sums, "lang string, number int, other int, value long")
    total = parts.groupBy("lang", "number", "other").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "number", "source")
    others = names.select("lang", F.col("number").alias("other"), F.col("source").alias("item"))
    return total.join(names, ["lang", "number"]).join(others, ["lang", "other"]).select("lang", "source", "item", "value")


def _term_values(counts: DataFrame, top: int) -> DataFrame:
    """(lang, source, ordinal, value, rank) of the terms that a source uses more than its language, `top` of each group.

    A group is ranked in ranges of terms first, so a large one is split.
    """
    everywhere = Window.partitionBy("lang", "ordinal")

    def per_unit(n: str, total: str) -> Column:
        return F.lit(1) + F.expr(f"cast({UNIT} as decimal(18,0)) * cast({n} + 1 as decimal(19,0)) div cast({total} as decimal(19,0))")

    rows = (
        counts.withColumn("n_lang", F.sum("n").over(everywhere))
        .withColumn("p", per_unit("n", "total + terms"))
        .withColumn("q", per_unit("n_lang", "lang_total + terms"))
        .where("p > q")
        .select("lang", "source", "ordinal", F.expr("(p - q) * (p - q) div q").alias("value"))
    )
    order = (F.desc("value"), F.asc("ordinal"))
    part = Window.partitionBy("lang", "source", F.floor(F.col("ordinal") / RANKED_TERMS)).orderBy(*order)
    first = rows.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    return ranked.where(F.col("rank") <= top)


def audit(
    documents: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    least: int = LEAST_TEXTS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every group (lang, source) that occurs.

    Terms are runs of ASCII letters, lower-cased, and of characters beyond ASCII; a language keeps those in at least
    `least` of its texts. Part `pair` has the divergence from each other source of the language, part `term` the `top`
    terms that the source uses most beyond the language as a whole. Null texts, languages and sources count as ''.
    Groups without terms are compared like others; a language that keeps none has values of 0. A source alone in its
    language has no pairs. Repeated rows count each; equal values are ranked by the item; an empty table gives no rows.
    Other columns are not read. The driver holds one entry for each block of `BLOCK_TERMS` terms, and the transducers
    themselves up to `BROADCAST_BYTES`; beyond that, the counted terms travel to the transducers, with the same rows.
    """
    spark = documents.sparkSession
    ship_code(spark)
    docs = documents.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((text_column, "text"), (lang_column, "lang"), (source_column, "source"))]
    )
    terms = written(kept_terms(docs, least), "kept-terms")
    built = written(blocks_of(terms), "transducers")
    listed = built.select("lang", "first", "n", F.length("data").alias("size")).collect()
    directory = Directory([(r["lang"], r["first"], r["n"]) for r in listed])
    if sum(r["size"] for r in listed) <= BROADCAST_BYTES:
        data = {directory.by_term(r["lang"], r["first"].encode()): bytes(r["data"]) for r in built.collect()}
        counted = _streamed(docs, directory, data)
    else:
        counted = _sent(docs, terms, _numbered(built, directory), directory)
    counts = written(counted, "term-counts")
    return _report(docs, counts, built, directory, top)


def _numbered(built: DataFrame, directory: Directory) -> DataFrame:
    """The blocks with their number and the ordinal of their first term."""
    bases = directory.bases()

    @F.arrow_udf("struct<block:int,base:long>")
    def place(lang: pa.Array, first: pa.Array) -> pa.Array:
        pairs = zip(lang.to_pylist(), first.cast(pa.binary()).to_pylist(), strict=True)
        numbers = [directory.by_term(*p) for p in pairs]
        return pa.StructArray.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array([bases[n] for n in numbers], pa.int64())], names=["block", "base"]
        )

    return built.select(place(F.col("lang"), F.col("first")).alias("p"), "data").select("p.block", "p.base", "data")


def _report(docs: DataFrame, counts: DataFrame, built: DataFrame, directory: Directory, top: int) -> DataFrame:
    within = Window.partitionBy("lang")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kept = built.groupBy("lang").agg(F.sum("n").alias("terms"))
    groups = written(
        docs.select("lang", "source").distinct()
        .join(totals, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .select(
            "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"),
            F.row_number().over(within.orderBy("source")).alias("number"), F.count(F.lit(1)).over(within).alias("sources"),
            F.coalesce(F.sum("total").over(within), F.lit(0)).alias("lang_total"),
        ),
        "groups",
    )
    rows = counts.join(groups, ["lang", "source"])
    pairs = _pair_values(groups, rows)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pair = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))

    @F.arrow_udf("int")
    def block_of(lang: pa.Array, ordinal: pa.Array) -> pa.Array:
        rows = zip(lang.to_pylist(), ordinal.to_pylist(), strict=True)
        return pa.array([directory.by_ordinal(*r) for r in rows], pa.int32())

    def spell(arcs: Transducer, base: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        items = [arcs.term(o - base) for o in batch.column("ordinal").to_pylist()]
        columns = [batch.column(c) for c in ("lang", "source")]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(["term"] * len(items)), _strings(items), batch.column("value"), batch.column("rank")],
            names=["lang", "source", "part", "item", "value", "rank"],
        )

    best = _term_values(rows, top).withColumn("block", block_of(F.col("lang"), F.col("ordinal")))
    schema = "lang string, source string, part string, item string, value long, rank int"
    return pair.unionByName(_meet(_numbered(built, directory), best, F.xxhash64("source"), spell, schema))
