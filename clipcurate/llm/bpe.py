"""Byte-level BPE by reduction of a monoid tree: halves are encoded on their own and joined at their border.

Why a join is right: a token sequence is the encoding of its bytes exactly if every two neighbours encode to
themselves when their bytes are encoded together. Inside both halves that holds already. A join encodes the bytes
of a few tokens on either side of the border anew, and takes more of them until the first and last new token
agree with their outer neighbours; then it holds for the whole sequence.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from clipcurate.llm.common import map_rows, remembered, texts_of

#: Pieces of up to this many bytes are leaves of the tree, and up to this many merge by searching a short list.
LEAF_BYTES = 6
SHORT_BYTES = 48
#: Distinct pieces that a worker remembers before it forgets all of them, and leaves and token pairs, each.
MOST_KNOWN = 120_000
MOST_PARTS = 60_000
_NEVER = 1 << 40


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks from lines of a base64 token and its number."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class TreeEncoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._leaves: dict[bytes, list[int]] = {}
        self._borders: dict[tuple[int, int], list[int]] = {}

    def leaf(self, piece: bytes) -> list[int]:
        """Merge the lowest-ranked neighbours, leftmost first, until none is left."""
        if len(piece) <= SHORT_BYTES:
            return self._short_leaf(piece)
        ranks = self.ranks
        size = len(piece)
        if size == 1:
            return [ranks[piece]]
        # A linked list of parts by their start; the heap may hold outdated pairs, which are skipped.
        end = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        alive = [True] * size
        heap = [(r, i, i + 2) for i in range(size - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= size or end[end[i]] != stop or stop <= end[i]:
                continue
            gone = end[i]
            alive[gone] = False
            end[i] = stop
            if stop < size:
                before[stop] = i
                if (r := ranks.get(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if before[i] >= 0 and (r := ranks.get(piece[before[i] : stop])) is not None:
                heapq.heappush(heap, (r, before[i], stop))
        out, i = [], 0
        while i < size:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def _short_leaf(self, piece: bytes) -> list[int]:
        """The same for few bytes, where searching the pairs costs less than keeping a heap."""
        rank = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank(piece[i : i + 2], _NEVER) for i in range(len(piece) - 1)]
        while pairs and (least := min(pairs)) != _NEVER:
            i = pairs.index(least)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], _NEVER)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], _NEVER)
        return [self.ranks[part] for part in parts]

    def _border(self, left: int, right: int) -> list[int]:
        """The encoding of two tokens' bytes together, remembered, as most joins need no more than that."""
        pair = (left, right)
        known = self._borders.get(pair)
        if known is None:
            if len(self._borders) > MOST_PARTS:
                self._borders.clear()
            known = self._borders[pair] = self.leaf(self.tokens[left] + self.tokens[right])
        return known

    def agree(self, left: int, right: int) -> bool:
        """Whether two tokens side by side encode to themselves."""
        return self._border(left, right)[0] == left

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left + right
        window = self._border(left[-1], right[0])
        if window[0] == left[-1]:
            return left + right
        reach = 1
        while True:
            start, stop = max(0, len(left) - reach), min(len(right), reach)
            if (start == 0 or self.agree(left[start - 1], window[0])) and (
                stop == len(right) or self.agree(window[-1], right[stop])
            ):
                return left[:start] + window + right[stop:]
            reach *= 2
            start, stop = max(0, len(left) - reach), min(len(right), reach)
            window = self.leaf(b"".join(map(self.tokens.__getitem__, left[start:] + right[:stop])))

    def tree(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF_BYTES:
            known = self._leaves.get(piece)
            if known is None:
                if len(self._leaves) > MOST_PARTS:
                    self._leaves.clear()
                known = self._leaves[piece] = self.leaf(piece)
            return known
        middle = len(piece) // 2
        return self.join(self.tree(piece[:middle]), self.tree(piece[middle:]))

    def encode(self, piece: bytes) -> list[int]:
        """A piece that is a token as a whole is that token; others are reduced."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.tree(piece)

    def decode(self, ids) -> bytes:
        """Concatenation up the tree: halves of the sequence are decoded and put together."""
        if len(ids) <= 4096:
            return b"".join(map(self.tokens.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


class _Pieces(dict):
    """The ids of pieces met before, as little-endian unsigned 32-bit integers."""

    def __init__(self, encoder: TreeEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encoder.encode(piece.encode()), "<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class TextEncoder:
    """Encodes whole texts. Matches of the pattern are encoded separately and never merge with each other."""

    def __init__(self, ranks: bytes, pattern: str):
        self.encoder = TreeEncoder(parse_ranks(ranks))
        self.split = regex.compile(pattern).findall
        self.pieces = _Pieces(self.encoder)

    @classmethod
    def of(cls, ranks: bytes, pattern: str) -> TextEncoder:
        """One encoder per worker process, so that tasks share what they remember until another operator comes."""
        return remembered((hashlib.sha256(ranks).digest(), pattern), lambda: cls(ranks, pattern))

    def encode(self, text: str) -> bytes:
        if len(self.pieces) > MOST_KNOWN:
            self.pieces.clear()
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return self.encoder.decode(np.frombuffer(ids, "<u4").tolist())


def read_ranks(path: str) -> bytes:
    """The vocabulary file, read by the driver; it is a few megabytes at most and goes to the tasks by broadcast."""
    with open(path, "rb") as file:
        return file.read()


def encode(documents: DataFrame, ranks: bytes, pattern: str, ids: str | None = "token_ids") -> DataFrame:
    """Encode the whole `text` of any table and decode it again.

    Adds `token_ids` (little-endian unsigned 32-bit integers; left out for `ids=None`), `n_tokens`, `ids_sha256`,
    `decoded_sha256` and `round_trip` (whether decoding gives back the text). A null or empty text has no ids. No
    special tokens are used: their strings are ordinary text. Equal texts get equal ids; other columns are passed
    on, and columns of these names are replaced.
    """
    added = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string", "round_trip": "boolean"}
    if ids:
        added = {ids: "binary"} | added
    columns = [c for c in documents.columns if c not in added]
    shared = documents.sparkSession.sparkContext.broadcast((ranks, pattern))

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        encoder = TextEncoder.of(*shared.value)
        coded, n, digest, decoded, same = [], [], [], [], []
        for text in texts_of(batch):
            found = encoder.encode(text)
            back = encoder.decode(found)
            n.append(len(found) // 4)
            digest.append(hashlib.sha256(found).hexdigest())
            decoded.append(hashlib.sha256(back).hexdigest())
            same.append(back == text.encode())
            if ids:
                coded.append(found)
        out = [pa.array(n, pa.int64()), pa.array(digest), pa.array(decoded), pa.array(same, pa.bool_())]
        return [pa.array(coded, pa.binary()), *out] if ids else out

    return map_rows(documents.select(*columns), run, ", ".join(f"`{k}` {v}" for k, v in added.items()), keeps=True)
