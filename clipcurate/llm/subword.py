"""Hashed subwords, averaged subword embeddings and their training by stochastic gradient descent."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np

_STEP = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    mixed = hashes * _MIX
    return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64)


def ngram_buckets(words: list[bytes], low: int, high: int, buckets: int):
    """Yield (bucket, valid) per byte position and length: the hashed n-grams of `<word>`, and then whole words.

    Also returns, as the first item, where each word starts and how long it is with its two marks.
    """
    data = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    left = np.repeat(starts + lengths, lengths) - np.arange(len(data))
    grams = []
    rolling = data + np.uint64(1)
    for n in range(2, high + 1):
        rolling = rolling[:-1] * _STEP + data[n - 1 :] if len(rolling) > 1 else rolling[:0]
        if n >= low and len(rolling):
            grams.append((_bucket(rolling + np.uint64(n), buckets), left[: len(rolling)] >= n))
    whole = _bucket(word_hashes(words) + np.uint64(1 << 40), buckets)
    return starts, lengths, grams, whole


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


@dataclass
class Space:
    """How words become buckets: byte n-grams of `low` to `high` with word marks, and the word itself.

    With `pair_weight`, two neighbouring words are a bucket too, which counts as so many of the others.
    """

    low: int
    high: int
    buckets: int
    pair_weight: float = 0.0

    def pairs(self, hashes: np.ndarray) -> np.ndarray:
        """Buckets of neighbouring words, given the hashes of a document's words in their order.

        A pair is hashed by the difference of its words' hashes, so its order counts, and a word that follows itself
        is the same pair whichever word it is: repetition is learnt once and not word by word.
        """
        return _bucket(hashes[1:] - hashes[:-1] + np.uint64(1 << 41), self.buckets)

    def features(self, found_words: Counter | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct buckets of the words and their shares, which add up to 1. For pairs, the words in their order."""
        counts = Counter(found_words)
        words = list(counts)
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.float32)
        number = np.fromiter(counts.values(), np.float64, len(words))
        starts, lengths, grams, whole = ngram_buckets(words, self.low, self.high, self.buckets)
        of = np.repeat(np.arange(len(words)), lengths)
        ids, weights = [whole], [number]
        for bucket, valid in grams:
            ids.append(bucket[valid])
            weights.append(number[of[: len(bucket)][valid]])
        if self.pair_weight:
            ids.append(self.pairs(word_hashes(found_words)))
            weights.append(np.full(len(ids[-1]), self.pair_weight))
        found, at = np.unique(np.concatenate(ids), return_inverse=True)
        total = np.bincount(at, np.concatenate(weights))
        return found, (total / total.sum()).astype(np.float32)

    def sums(self, words: list[bytes], values: np.ndarray) -> np.ndarray:
        """Per word the sum of its buckets' rows of `values`, with the number of buckets as a last column."""
        starts, lengths, grams, whole = ngram_buckets(words, self.low, self.high, self.buckets)
        padded = np.vstack([values, np.zeros((1, values.shape[1]), values.dtype)])
        size = int(lengths.sum())
        total = np.zeros((size, values.shape[1] + 1), np.float32)
        for bucket, valid in grams:
            total[: len(bucket), :-1] += padded[np.where(valid, bucket, self.buckets)]
            total[: len(bucket), -1] += valid
        out = np.add.reduceat(total, starts, axis=0)
        out[:, :-1] += values[whole]
        out[:, -1] += 1
        return out


@dataclass
class Model:
    """Averaged subword embeddings under a linear softmax, folded into one row of logits per bucket."""

    space: Space
    classes: list
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0
    """Least lead, as `leads` gives it, of an answer that is not rejected."""

    def scores(self, sums: np.ndarray) -> np.ndarray:
        """From per-document sums as `Space.sums` gives them. A document without words gets the bias alone."""
        return sums[:, :-1] / np.maximum(sums[:, -1:], 1) + self.bias

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        return softmax(self.scores(sums) / self.temperature)


def leads(scores: np.ndarray) -> np.ndarray:
    """By how much the highest of two or more scores exceeds the next: the log-odds of the answer before scaling."""
    ordered = np.sort(scores, axis=-1)
    return ordered[..., -1] - ordered[..., -2]


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


#: Share of the right answers among the rows kept apart that are not rejected, and how many of them tell a limit.
KEEP, LEAST_RIGHT = 0.999, 10


def train(
    examples: list[tuple[Counter, object]],
    space: Space,
    dim: int = 16,
    epochs: int = 12,
    rate: float = 0.5,
    calibration: float = 0.2,
    seed: int = 5,
) -> Model:
    """Fit embeddings and softmax by stochastic gradient descent, one document at a time.

    Every class has the same total weight. Steps are scaled per parameter by the root of their summed squares.
    The first `calibration` share of the shuffled examples is kept apart to choose the temperature and the limit of
    rejection, which `KEEP` of the right answers among them reach. With fewer than `1 / calibration` examples none is
    kept apart; the temperature is then 1, and nothing is rejected. Nor is it if fewer than `LEAST_RIGHT` of them are right.
    """
    classes = sorted({label for _, label in examples}, key=str)
    if len(classes) < 2:
        size = max(len(classes), 1)
        return Model(space, classes, np.zeros((space.buckets, size), np.float32), np.zeros(size, np.float32))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(examples))
    apart = order[: int(len(order) * calibration)]
    fitted = order[len(apart) :]
    features = [space.features(counts) for counts, _ in examples]
    target = np.array([classes.index(label) for _, label in examples])
    share = np.bincount(target[fitted], minlength=len(classes))
    weight = len(fitted) / (len(classes) * np.maximum(share, 1))
    embed = rng.normal(0, 0.1, (space.buckets, dim)).astype(np.float32)
    squares = np.full(space.buckets, 1e-8, np.float32)
    out = rng.normal(0, 0.1, (dim, len(classes))).astype(np.float32)
    out_squares = np.full_like(out, 1e-6)
    bias = np.zeros(len(classes), np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(fitted):
            ids, share_of = features[i]
            hidden = share_of @ embed[ids] if len(ids) else np.zeros(dim, np.float32)
            error = softmax(hidden @ out + bias)
            error[target[i]] -= 1
            error *= min(weight[target[i]], 10.0)
            if len(ids):
                back = np.outer(share_of, out @ error)
                squares[ids] += (back**2).mean(axis=1)
                embed[ids] -= 0.3 * step * back / np.sqrt(squares[ids])[:, None]
                grad = np.outer(hidden, error)
                out_squares += grad**2
                out -= step * grad / np.sqrt(out_squares)
            bias -= 0.05 * step * error
    model = Model(space, classes, (embed @ out).astype(np.float32), bias)
    if len(apart):
        scores = np.array([features[i][1] @ model.logits[features[i][0]] + bias for i in apart])
        truth = target[apart]
        losses = {
            t: -np.log(softmax(scores / t)[np.arange(len(truth)), truth] + 1e-12).mean()
            for t in (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0, 5.6, 8.0)
        }
        model.temperature = min(losses, key=losses.get)
        right = np.sort(leads(scores)[scores.argmax(axis=1) == truth])
        if len(right) >= LEAST_RIGHT:
            model.reject_below = float(right[int((1 - KEEP) * len(right))])
    return model


#: Words that a task remembers before it forgets all of them, and words whose rows are computed at once.
MOST_KNOWN, WORDS_AT_ONCE = 60_000, 10_000


class WordRows(dict):
    """Numbers for words, with a row of sums each. Cleared when it exceeds `most` words."""

    def __init__(self, model: Model, most: int = MOST_KNOWN):
        super().__init__()
        self.model, self.most = model, most
        self.rows = np.zeros((1024, len(model.bias) + 1), np.float32)
        self.hashes = np.zeros(1024, np.uint64)
        self.known, self.pending = 0, []

    def __missing__(self, word):
        number = self[word] = self.known + len(self.pending)
        self.pending.append(word)
        return number

    def settle(self) -> None:
        """Compute the rows of the words met since the last call."""
        if not self.pending:
            return
        need = self.known + len(self.pending)
        if need > len(self.rows):
            grown = np.zeros((2 * need, self.rows.shape[1]), np.float32)
            grown[: self.known] = self.rows[: self.known]
            self.rows = grown
            self.hashes = np.resize(self.hashes, len(grown))
        for start in range(0, len(self.pending), WORDS_AT_ONCE):
            part = self.pending[start : start + WORDS_AT_ONCE]
            encoded = [w.encode() if isinstance(w, str) else w for w in part]
            self.rows[self.known : self.known + len(part)] = self.model.space.sums(encoded, self.model.logits)
            self.hashes[self.known : self.known + len(part)] = word_hashes(encoded)
            self.known += len(part)
        self.pending = []

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()
            self.known, self.rows = 0, np.zeros((1024, self.rows.shape[1]), np.float32)
            self.hashes = np.zeros(1024, np.uint64)


def document_sums(rows: WordRows, documents: list[list]) -> np.ndarray:
    """Per document the sums of its words' rows. Words are numbered for the whole list before any is scored."""
    space, logits = rows.model.space, rows.model.logits
    rows.trim()
    numbers = [np.fromiter(map(rows.__getitem__, words), np.int64, len(words)) for words in documents]
    rows.settle()
    out = np.zeros((len(documents), rows.rows.shape[1]), np.float64)
    for i, ids in enumerate(numbers):
        for start in range(0, len(ids), 100_000):
            out[i] += rows.rows[ids[start : start + 100_000]].sum(axis=0, dtype=np.float64)
            if space.pair_weight:
                pairs = space.pairs(rows.hashes[ids[start : start + 100_001]])
                out[i, :-1] += space.pair_weight * logits[pairs].sum(axis=0, dtype=np.float64)
                out[i, -1] += space.pair_weight * len(pairs)
    return out
