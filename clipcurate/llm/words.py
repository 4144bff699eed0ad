"""Token ids of whole texts through a memory of words, for vocabularies whose tokens never span a space."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from clipcurate.llm.common import remembered

#: Distinct words, each, that a worker remembers before it forgets all of them. Results do not depend on it.
MOST_KNOWN = 300_000
#: What lies between spaces is plain if it has Latin letters, digits and signs only. An apostrophe is left to the
#: library, as it begins tokens of its own.
_PLAIN = "^[A-Za-z0-9!-&(-/:-@\\[-`{-~À-ÖØ-öø-ÿ]*$"
_PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\\[-`{-~]+|\n")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: the byte's own if it is printable, else one after 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class WordIds:
    """Ids by a `tokenizers` file that lower-cases and drops white space.

    Such a tokenizer treats what lies between spaces on its own, so each distinct piece between spaces of a batch is
    encoded once: plain ones part by part, with parts merged by the library's model and remembered, all others by the
    whole library. The ids of a text are those of its pieces in a row.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self._letters = byte_letters()
        self._parts: dict[str, bytes] = {}
        self._others: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordIds:
        """One encoder per worker process and file."""
        return remembered(path, lambda: cls(path))

    def _part(self, part: str) -> bytes:
        spelt = part if part.isascii() else part.encode().decode("latin-1").translate(self._letters)
        return array("I", [t.id for t in self.library.model.tokenize(spelt)]).tobytes()

    def _known(self, memory: dict[str, bytes], items: list[str], encode) -> list[bytes]:
        if len(memory) > MOST_KNOWN:
            memory.clear()
        for item in set(items) - memory.keys():
            memory[item] = encode(item)
        return list(map(memory.__getitem__, items))

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A pool of ids, and where each word's ids start in it and how many they are."""
        plain = pc.match_substring_regex(words, _PLAIN)
        simple, others = words.filter(plain), words.filter(pc.invert(plain)).to_pylist()
        if len(simple):
            joined = pc.binary_join(pa.ListArray.from_arrays([0, len(simple)], simple), "\n")[0].as_py()
            parts = _PARTS.findall(joined.lower())
        else:
            parts = []
        data = self._known(self._parts, parts, lambda p: b"" if p == "\n" else self._part(p))
        number = np.cumsum(np.fromiter(map("\n".__eq__, parts), bool, len(parts)))
        sizes = np.fromiter(map(len, data), np.int64, len(data)) // 4
        counts = np.bincount(number, sizes, len(simple)).astype(np.int64) if parts else np.zeros(len(simple), np.int64)
        rest = self._known(
            self._others, others, lambda w: array("I", self.library.encode(w, add_special_tokens=False).ids).tobytes()
        )
        lengths = np.empty(len(words), np.int64)
        mask = plain.to_numpy(zero_copy_only=False)
        lengths[mask] = counts
        lengths[~mask] = np.fromiter(map(len, rest), np.int64, len(rest)) // 4
        order = np.concatenate([np.flatnonzero(mask), np.flatnonzero(~mask)])
        starts = np.empty(len(words), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return np.frombuffer(b"".join(data + rest), "<u4"), starts, lengths

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of an array without nulls."""
        if not len(texts):
            return []
        spaced = pc.replace_substring(pc.replace_substring(texts, "\n", " "), "\t", " ")
        split = pc.split_pattern(spaced, " ")
        borders = split.offsets.to_numpy()
        coded = split.values.slice(borders[0], borders[-1] - borders[0]).dictionary_encode()
        pool, starts, lengths = self._distinct(coded.dictionary)
        codes = coded.indices.to_numpy()
        each = lengths[codes]
        ends = np.cumsum(each)
        # The places in the pool of all ids of all words, word by word.
        places = np.arange(ends[-1]) + np.repeat(starts[codes] - (ends - each), each)
        flat = pool[places]
        cuts = np.concatenate([[0], ends])[borders - borders[0]].tolist()
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
