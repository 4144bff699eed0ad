"""A minimal acyclic transducer that maps each of a sorted list of terms to its place in the list.

States are numbered, arcs are sorted by (state, byte). An arc carries the number of terms that sort before all that go
through it, among those of its state; along a path these add up to the ordinal of the term.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

#: Terms of more bytes are followed one by one, shorter ones all at once.
LONG_BYTES = 64
_HEADER = struct.Struct("<qqqq")


@dataclass(frozen=True)
class Transducer:
    keys: np.ndarray  # of arcs: state * 256 + byte, ascending
    targets: np.ndarray
    skips: np.ndarray
    final: np.ndarray  # of states
    root: int

    def to_bytes(self) -> bytes:
        width = 4 if len(self.final) < 1 << 23 else 8
        parts = (self.keys.astype(f"<i{width}"), self.targets.astype("<i4"), self.skips.astype("<i4"), self.final.astype("u1"))
        return _HEADER.pack(len(self.keys), len(self.final), self.root, width) + b"".join(p.tobytes() for p in parts)

    @staticmethod
    def from_bytes(data: bytes) -> Transducer:
        arcs, states, root, width = _HEADER.unpack_from(data)
        at, parts = _HEADER.size, []
        for n, kind in ((arcs, f"<i{width}"), (arcs, "<i4"), (arcs, "<i4"), (states, "u1")):
            parts.append(np.frombuffer(data, kind, n, at))
            at += parts[-1].nbytes
        return Transducer(*parts[:3], parts[3].astype(bool), root)

    @staticmethod
    def together(many: list[Transducer]) -> tuple[Transducer, np.ndarray]:
        """One set of arcs with the states of all, and the root of each."""
        offsets = np.cumsum([0] + [len(t.final) for t in many])
        kind = np.int32 if offsets[-1] < 1 << 23 else np.int64
        keys = [t.keys.astype(kind) + (int(o) << 8) for t, o in zip(many, offsets, strict=False)]
        targets = [t.targets.astype(np.int32) + int(o) for t, o in zip(many, offsets, strict=False)]
        empty = np.zeros(0, np.int32)
        joined = Transducer(
            np.concatenate([empty, *keys]).astype(kind), np.concatenate([empty, *targets]),
            np.concatenate([empty, *[t.skips for t in many]]), np.concatenate([np.zeros(0, bool), *[t.final for t in many]]), 0,
        )
        return joined, np.array([t.root + int(o) for t, o in zip(many, offsets, strict=False)], np.int64)

    def ordinals(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, roots: np.ndarray | None = None) -> np.ndarray:
        """The ordinal of each term data[start : start + length], -1 for what is not a term. `roots`: a root for each."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.keys):
            return out
        alive = np.flatnonzero((lengths > 0) & (lengths <= LONG_BYTES))
        kind = self.keys.dtype
        roots = np.full(len(starts), self.root) if roots is None else roots
        state = roots[alive].astype(kind)
        total = np.zeros(len(alive), np.int64)
        at, left = starts[alive], lengths[alive]
        step = 0
        while len(alive):
            key = (state << 8) | data[at + step].astype(kind)
            arc = np.searchsorted(self.keys, key)
            arc[arc == len(self.keys)] = 0
            good = self.keys[arc] == key
            alive, at, left, arc, total = alive[good], at[good], left[good], arc[good], total[good]
            state = self.targets[arc].astype(kind)
            total = total + self.skips[arc]
            step += 1
            done = left == step
            ends = done & self.final[state]
            out[alive[ends]] = total[ends]
            on = ~done
            alive, at, left, state, total = alive[on], at[on], left[on], state[on], total[on]
        for i in np.flatnonzero(lengths > LONG_BYTES):
            out[i] = self.ordinal(data[starts[i] : starts[i] + lengths[i]], int(roots[i]))
        return out

    def ordinal(self, term: Iterable[int], root: int | None = None) -> int:
        state, total = self.root if root is None else root, 0
        for byte in term:
            key = (state << 8) | int(byte)
            arc = int(np.searchsorted(self.keys, key))
            if arc == len(self.keys) or self.keys[arc] != key:
                return -1
            state, total = int(self.targets[arc]), total + int(self.skips[arc])
        return total if self.final[state] else -1

    def term(self, ordinal: int) -> bytes:
        """The term with this ordinal."""
        state, out = self.root, bytearray()
        while True:
            if self.final[state] and ordinal == 0:
                return bytes(out)
            first, end = np.searchsorted(self.keys, [state << 8, (state + 1) << 8])
            arc = first + int(np.searchsorted(self.skips[first:end], ordinal, side="right")) - 1
            ordinal -= int(self.skips[arc])
            out.append(int(self.keys[arc]) & 255)
            state = int(self.targets[arc])


def build(terms: Iterable[bytes]) -> Transducer:
    """The minimal transducer of distinct terms in ascending order, none of them empty.

    What no later term can share any more is frozen state by state, from the end, into an equal state if there is one.
    """
    register: dict[tuple, int] = {}
    arcs: list[tuple[tuple[int, int], ...]] = []
    final: list[bool] = []
    counts: list[int] = []
    # The path of the last term: each state's finished arcs, whether it ends a term, and the byte that leads on.
    path: list[list] = [[[], False]]
    last = b""

    def freeze(depth: int) -> None:
        while len(path) > depth + 1:
            done, ends = path.pop()
            key = (ends, *done)
            state = register.get(key)
            if state is None:
                state = register[key] = len(arcs)
                arcs.append(tuple(done))
                final.append(ends)
                counts.append(ends + sum(counts[t] for _, t in done))
            path[-1][0].append((last[len(path) - 1], state))

    for term in terms:
        if term <= last:
            raise ValueError("terms must be distinct, not empty and in ascending order")
        shared = 0
        for a, b in zip(last, term, strict=False):
            if a != b:
                break
            shared += 1
        freeze(shared)
        last = term
        path += [[[], False] for _ in range(len(term) - shared)]
        path[-1][1] = True
    freeze(0)
    done, ends = path[0]
    arcs.append(tuple(done))
    final.append(ends)
    return Transducer(*_flat(arcs, final, counts), np.array(final, bool), len(arcs) - 1)


def _flat(arcs: list, final: list[bool], counts: list[int]) -> Iterator[np.ndarray]:
    keys, targets, skips = [], [], []
    for state, out in enumerate(arcs):
        before = int(final[state])
        for byte, target in out:
            keys.append((state << 8) | byte)
            targets.append(target)
            skips.append(before)
            before += counts[target]
    return (np.array(x, np.int64) for x in (keys, targets, skips))
