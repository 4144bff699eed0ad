"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcurate.llm.common import keeping, map_rows, texts_of

#: Words of a window. An item with fewer is one window as a whole.
WINDOW = 10
#: Item words in one automaton. A larger benchmark is split into several, each matched against every document.
BLOCK_WORDS = 200_000
# Entries of the table of known neighbours.
_BLOOM = 1 << 22

# What is not a word character becomes a space; A-Z become a-z. Bytes from 0x80 belong to words.
_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TO_WORDS = bytes(b if b in _WORD else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Words of digits, letters a-z (A-Z are lower-cased) and all characters beyond ASCII."""
    return text.encode().translate(_TO_WORDS).split()


class Automaton:
    """Generalised suffix automaton over word numbers.

    A state stands for word sequences that end at the same places of the items. `link` leads to the longest
    suffix that ends at more places. States whose sequences can have exactly `window` words know their items;
    states that hold a whole short item know its length and number.
    """

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            coded.append((item, ids))
            last = 0
            for word in ids:
                last = self._extend(last, word)
        self._bigrams(coded)
        self._mark(coded)

    def _extend(self, last: int, word: int) -> int:
        following = self.next[last].get(word)
        if following is not None:
            if self.length[following] == self.length[last] + 1:
                return following
            return self._clone(last, following, word)
        state = self._add({}, 0, self.length[last] + 1)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            following = self.next[at][word]
            fits = self.length[following] == self.length[at] + 1
            self.link[state] = following if fits else self._clone(at, following, word)
        return state

    def _add(self, following: dict[int, int], link: int, length: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, at: int, state: int, word: int) -> int:
        copy = self._add(dict(self.next[state]), self.link[state], self.length[at] + 1)
        self.link[state] = copy
        while at >= 0 and self.next[at].get(word) == state:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _bigrams(self, coded) -> None:
        """Which neighbours occur in items, folded into a table of fixed size: no occurring pair is missed."""
        self.pairs = np.zeros(_BLOOM, bool)
        for _, ids in coded:
            row = np.array(ids, np.int64)
            self.pairs[_pair(row[:-1], row[1:])] = True
        self.least = min((min(len(ids), self.window) for _, ids in coded if ids), default=self.window)

    def _mark(self, coded) -> None:
        self.items_at: dict[int, set[int]] = {}
        whole: dict[int, list[tuple[int, int]]] = {}
        for item, ids in coded:
            if not ids:
                continue
            state, length = 0, 0
            for word in ids:
                state, length = self.step(state, length, word)
                if length >= self.window:
                    state = self._cut(state)
                    length = self.window
                    self.items_at.setdefault(state, set()).add(item)
            if len(ids) < self.window:
                whole.setdefault(state, []).append((len(ids), item))
        # The short items that end where a state ends are those of the state and of the states it links to.
        self.short_at: dict[int, list[tuple[int, int]]] = {}
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__) if whole else ():
            found = whole.get(state, []) + self.short_at.get(self.link[state], [])
            if found:
                self.short_at[state] = found

    def _cut(self, state: int) -> int:
        """The state of the last `window` words of a state that has at least as many."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """Read a word: the longest suffix of what was read that occurs in an item, and its state."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        following = self.next[state].get(word)
        return (following, length + 1) if following is not None else (0, 0)

    def spans(self, words: list[bytes]) -> Iterator[tuple[int, int, set[int]]]:
        """Windows that occur in items: their first word, the word after their last, and the items."""
        known = self.vocabulary.get
        ids = np.array([known(w, 0) for w in words], np.int64)
        if not len(ids):
            return
        # Only runs of known neighbours that are long enough for a window go through the automaton.
        joined = np.zeros(len(ids) + 1, bool)
        joined[1:-1] = self.pairs[_pair(ids[:-1], ids[1:])] & (ids[:-1] > 0) & (ids[1:] > 0)
        breaks = np.flatnonzero(~joined)
        runs = np.diff(breaks)
        for i in np.flatnonzero((runs >= self.least) & (ids[breaks[:-1]] > 0)):
            first, after = int(breaks[i]), int(breaks[i + 1])
            state, length = 0, 0
            for at, word in enumerate(ids[first:after].tolist(), first + 1):
                state, length = self.step(state, length, word)
                if length >= self.window:
                    state, length = self._cut(state), self.window
                    yield at - self.window, at, self.items_at[state]
                for size, item in self.short_at.get(state, ()):
                    if size <= length:
                        yield at - size, at, {item}


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return ((left * 0x9E3779B1 + right) * 0x85EBCA77 >> 7) & (_BLOOM - 1)


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items with words, in blocks of a bounded number of words; the driver holds one block at a time."""
    block, size = [], 0
    for item, text in benchmark.select("item_id", "text").where(F.col("text").isNotNull()).toLocalIterator():
        words = words_of(text)
        if words:
            block.append((item, words))
            size += len(words)
            if size >= block_words:
                yield block
                block, size = [], 0
    if block:
        yield block


def match(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    spans: bool = False,
) -> DataFrame:
    """Match the whole `text` of every row against all windows of all items.

    Adds `n_words`, `n_hit` (words inside any occurrence of a window), `n_items` (items with an occurring window),
    `items_sha256` (of their ids, sorted as strings and joined by commas), `contaminated` (n_hit > 0) and, if wanted,
    `hit_spans` (merged spans of hit words, as word numbers). Null and empty texts have no words; null items and
    items without words have no window; a null item id counts as the id `null`. Repeated items count by their id.
    Each block of items is broadcast, bounded by `block_words` and the longest item; a task reads the blocks one after the other.
    """
    added = {"n_words": "long", "n_hit": "long", "n_items": "long", "items_sha256": "string", "contaminated": "boolean"}
    if spans:
        added["hit_spans"] = "array<struct<first:int,after:int>>"
    columns = [c for c in documents.columns if c not in added]
    context = documents.sparkSession.sparkContext
    blocks = [context.broadcast(block) for block in item_blocks(benchmark, block_words)]
    state: dict = {}

    def automaton(number: int) -> Automaton:
        # One at a time: memory does not grow with the benchmark.
        if state.get("number") != number:
            state.clear()
            state.update(number=number, automaton=Automaton(blocks[number].value, window))
        return state["automaton"]

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = texts_of(batch)
        sizes = [0] * len(texts)
        hits: dict[int, np.ndarray] = {}
        items: dict[int, set] = {}
        for number in range(max(len(blocks), 1)):
            found = automaton(number) if blocks else None
            for i, text in enumerate(texts):
                words = words_of(text)
                sizes[i] = len(words)
                for first, after, of in found.spans(words) if found else ():
                    if i not in hits:
                        hits[i], items[i] = np.zeros(len(words) + 1, np.int32), set()
                    hits[i][first] += 1
                    hits[i][after] -= 1
                    items[i] |= of
        n_hit, n_items, digest, where = [], [], [], []
        for i in range(len(texts)):
            covered = np.cumsum(hits[i])[:-1] > 0 if i in hits else np.zeros(0, bool)
            n_hit.append(int(covered.sum()))
            n_items.append(len(items.get(i, ())))
            names = sorted("null" if x is None else str(x) for x in items.get(i, ()))
            digest.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
            where.append([{"first": int(a), "after": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
        out = [pa.array(sizes, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64())]
        out += [pa.array(digest), pa.array([n > 0 for n in n_hit], pa.bool_())]
        if spans:
            out.append(pa.array(where, pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))))
        return out

    return map_rows(documents.select(*columns), run, ", ".join(f"{k} {v}" for k, v in added.items()))


#: A document goes as a whole when benchmark words are more than this share of it; else only the spans go.
MOST_COVERED = 0.5


def remove(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    most_covered: float = MOST_COVERED,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Cut the hit spans out of the texts, and drop documents of which more than `most_covered` of the words are hit.

    A span runs from the first byte of its first word to the last byte of its last one; what stands around it
    stays, so both sides remain apart. Untouched texts keep every byte; nulls stay null. A table with `n_chars`
    gets the new length there; its other columns come out as they are, whatever their names.
    """
    taken = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans", "_cut")
    return keeping(documents, taken, lambda docs: _cut_out(docs, benchmark, window, most_covered, block_words))


def _cut_out(documents: DataFrame, benchmark: DataFrame, window: int, most_covered: float, block_words: int) -> DataFrame:
    found = match(documents, benchmark, window, block_words, spans=True)
    found = found.where(~F.col("contaminated") | (F.col("n_hit") <= F.col("n_words") * most_covered))

    def cut(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("hit_spans").to_pylist(), strict=True):
            out.append(_without(text, spans) if spans else text)
        return [pa.array(out, pa.string())]

    hit = [c for c in documents.columns if c != "text"]
    cleaned = map_rows(found.select(*hit, "text", "hit_spans"), cut, "_cut string")
    changed = F.size("hit_spans") > 0
    columns = {c: F.col(c) for c in documents.columns} | {"text": F.col("_cut")}
    if "n_chars" in columns:
        kind = documents.schema["n_chars"].dataType
        columns["n_chars"] = F.when(changed, F.length("_cut").cast(kind)).otherwise(F.col("n_chars"))
    return cleaned.select(*[c.alias(name) for name, c in columns.items()])


def _without(text: str, spans: list[dict]) -> str:
    data = text.encode()
    blank = data.translate(_TO_WORDS)
    places = array("q")
    inside = False
    for at, byte in enumerate(blank):
        if (byte != 0x20) != inside:
            places.append(at)
            inside = not inside
    if inside:
        places.append(len(data))
    keep, start = [], 0
    for span in spans:
        keep.append(data[start : places[2 * span["first"]]])
        start = places[2 * span["after"] - 1]
    return b"".join([*keep, data[start:]]).decode()
