"""Encoding with a vocabulary whose tokens may have several characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A vocabulary is sent to every executor; one with more tokens than this is refused.
MAX_TOKENS = 2_000_000

_CLUSTER = regex.compile(r"\X")
# A code point needs 21 bits, so state and code point make one key of the transition table.
_CODE_BITS = 21
_CODE_MASK = (1 << _CODE_BITS) - 1

#: Code points that are encoded at once, unless a single text is longer.
CODES_AT_ONCE = 1 << 20
#: Up to so many pairs of a state and a code point the steps are a table that is looked up, beyond it a sorted list.
DENSE_STEPS = 1 << 23


class Trie:
    """Transitions as one flat table from state and code point to state, and the token id of each state."""

    def __init__(self, tokens: list[tuple[str, int]]):
        self.steps: dict[int, int] = {}
        self.ids: list[int | None] = [None]
        for token, token_id in tokens:
            state = 0
            for char in token:
                key = state << _CODE_BITS | ord(char)
                if key not in self.steps:
                    self.steps[key] = len(self.ids)
                    self.ids.append(None)
                state = self.steps[key]
            if self.ids[state] is None or token_id < self.ids[state]:
                self.ids[state] = token_id

    def longest(self, text: str, start: int, ends: set[int] | None, within: int) -> tuple[int, int | None]:
        """End and id of the longest token at `start` that ends in `ends` (None: anywhere), not after `within`."""
        state, found = 0, (start, None)
        for at in range(start, within):
            state = self.steps.get(state << _CODE_BITS | ord(text[at]))
            if state is None:
                break
            if self.ids[state] is not None and (ends is None or at + 1 in ends):
                found = at + 1, self.ids[state]
        return found

    def encode(self, text: str, unknown: int, clusters: bool) -> list[int]:
        ends = [m.end() for m in _CLUSTER.finditer(text)] if clusters else None
        whole = None if ends is None else set(ends)
        out, at, cluster = [], 0, 0
        while at < len(text):
            end, token_id = self.longest(text, at, whole, len(text))
            if token_id is None and ends is not None:
                # No token ends where a cluster does: one inside this cluster, then.
                while ends[cluster] <= at:
                    cluster += 1
                end, token_id = self.longest(text, at, None, ends[cluster])
            out.append(unknown if token_id is None else token_id)
            at = max(end, at + 1)
        return out


class Table:
    """The trie as arrays, for the longest tokens at all places of many texts in a few steps."""

    def __init__(self, trie: Trie):
        keys = np.array(sorted(trie.steps), np.int64)
        after = np.array([trie.steps[k] for k in keys.tolist()], np.int32)
        letters, number = np.unique(keys & _CODE_MASK, return_inverse=True)
        # The number of each code point among those of the tokens, from 1; 0 for all others.
        self.number = np.zeros(1 << _CODE_BITS, np.int32)
        self.number[letters] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        # State 0 is the start, and no step leads there: as an outcome it means none.
        places = (keys >> _CODE_BITS) * self.width + number + 1
        self.dense = len(trie.ids) * self.width <= DENSE_STEPS
        if self.dense:
            self.steps = np.zeros(len(trie.ids) * self.width, np.int32)
            self.steps[places] = after
        else:
            order = np.argsort(places)
            self.keys = np.append(places[order], np.iinfo(np.int64).max)
            self.steps = np.append(after[order], np.int32(0))
        self.has_id = np.array([i is not None for i in trie.ids])
        self.ids = np.array([i or 0 for i in trie.ids], np.int64)

    def encode(self, texts: list[str], unknown: int) -> list[np.ndarray]:
        """The ids of each text, as `Trie.encode` gives them without clusters."""
        out: list[np.ndarray] = []
        part, size = [], 0
        for text in texts:
            if part and size + len(text) > CODES_AT_ONCE:
                out += self._encode(part, unknown)
                part, size = [], 0
            part.append(text)
            size += len(text) + 1
        return out + (self._encode(part, unknown) if part else [])

    def _step(self, state: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The states after these code points, 0 where there is none."""
        key = state.astype(np.int64) * self.width + number
        if self.dense:
            return self.steps[key]
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.steps[at], 0)

    def _encode(self, texts: list[str], unknown: int) -> list[np.ndarray]:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        borders = np.cumsum(lengths + 1) - 1
        codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
        numbers = self.number[codes]
        numbers[borders] = 0
        inside = np.ones(len(codes), bool)
        inside[borders] = False
        after, ids = np.arange(1, len(codes) + 1), np.full(len(codes), unknown, np.int64)
        begin, state, size = np.flatnonzero(inside), np.zeros(int(lengths.sum()), np.int64), 0
        while len(begin):
            state = self._step(state, numbers[begin + size])
            found = state > 0
            begin, state, size = begin[found], state[found], size + 1
            ends = self.has_id[state]
            after[begin[ends]] = begin[ends] + size
            ids[begin[ends]] = self.ids[state[ends]]
        follow, places, at = after.tolist(), [], 0
        while at < len(follow):
            places.append(at)
            at = follow[at]
        chosen = np.array(places, np.int64)
        chosen = chosen[inside[chosen]]
        cuts = np.searchsorted(chosen, borders)
        return np.split(ids[chosen].astype(np.int32), cuts[:-1])


def trie_of(vocab: DataFrame) -> Trie:
    """The trie of `(token, token_id)`. Of several ids of a token the smallest counts; empty tokens do not."""
    tokens = vocab.where(F.length("token") > 0).select("token", "token_id").limit(MAX_TOKENS + 1).collect()
    if len(tokens) > MAX_TOKENS:
        raise ValueError(f"the vocabulary has more than {MAX_TOKENS} tokens")
    return Trie([(r.token, r.token_id) for r in tokens])


def token_encoder(vocab: DataFrame, unknown_id: int, clusters: bool = True):
    """A function from a text column to its token ids, the longest token first at each place.

    With `clusters` a token may not end inside a grapheme cluster, such as between a letter and its vowel sign, unless
    no token ends with that cluster. A code point of no token is one unknown id. A null text has null ids, an empty
    one none. Texts are encoded where they are read; only the vocabulary is sent.
    """
    trie = vocab.sparkSession.sparkContext.broadcast(trie_of(vocab))

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = trie.value
        # Clusters are looked at text by text; without them, all places of many texts go a step further together.
        table = None if clusters else Table(known)
        for batch in batches:
            texts = [t for t in batch if t is not None]
            found = iter(table.encode(texts, unknown_id) if table else [known.encode(t, unknown_id, True) for t in texts])
            yield pd.Series([None if t is None else next(found) for t in batch], dtype=object)

    return encode


def encode_tokens(texts: DataFrame, vocab: DataFrame, unknown_id: int, column: str = "text", clusters: bool = True) -> DataFrame:
    """`texts` with `token_ids`."""
    ids: Column = token_encoder(vocab, unknown_id, clusters)(F.col(column))
    return texts.withColumn("token_ids", ids)
