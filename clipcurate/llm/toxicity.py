"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learnt from document labels."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcurate.llm.common import give_back, keeping, labelled_sample, map_rows, texts_of
from clipcurate.llm.subword import MOST_KNOWN

BUCKETS = 1 << 18
#: Byte lengths of the word beginnings that are features beside the whole word.
STEMS = range(3, 12)
#: Bound of the training sample: rows of each label, and characters of a row.
SAMPLE_ROWS = 3_000
SAMPLE_CHARS = 20_000
THRESHOLD = 0.7

_TOKENS = re.compile(r"\w+|[.!?\n]+")
_BREAK = frozenset(".!?\n")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words: per word a row of buckets, and where they are valid. The first is the whole word."""
    data = np.frombuffer(b"".join(words) + b"\0" * max(STEMS), np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    buckets = np.zeros((len(words), 1 + len(STEMS)), np.int64)
    valid = np.ones(buckets.shape, bool)
    buckets[:, 0] = _bucket(np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) + np.uint64(1 << 40))
    rolling = np.zeros(len(words), np.uint64)
    for n in range(1, max(STEMS) + 1):
        rolling = rolling * np.uint64(0x100000001B3) + data[np.minimum(starts + n - 1, len(data) - 1)] + np.uint64(1)
        if n in STEMS:
            buckets[:, 1 + n - STEMS.start] = _bucket(rolling + np.uint64(n))
            valid[:, 1 + n - STEMS.start] = lengths >= n
    return buckets, valid


def _bucket(hashes: np.ndarray) -> np.ndarray:
    mixed = hashes * _MIX
    return ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        buckets, valid = word_features(words)
        return (self.weights[buckets] * valid).sum(axis=1)


def fit(
    documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_chars: int = SAMPLE_CHARS
) -> Model:
    """Learn `labels.toxic` from rows outside the held-out fold, up to `rows` of each label value."""
    model = learn(labelled_sample(documents, labels, "toxic", rows, max_chars))
    give_back()
    return model


def learn(
    sample: list[tuple[str, int]],
    epochs: int = 12,
    rate: float = 1.0,
    decay: float = 0.005,
    start: float = 10.0,
    least: int = 5,
    floor: float = -0.2,
    lift: float = 3.0,
    seed: int = 3,
) -> Model:
    """Fit word weights to (text, label) pairs.

    A sentence's probability is the logistic of the summed weights of its words; a document's is
    1 - product(1 - p) over its sentences. Each document is one step on the likelihood of its own label, with
    steps scaled per weight by the root of their summed squares, and documents of label 1 weigh `lift` times. Buckets
    met in fewer than `least` documents are left out, and no weight falls below `floor`.
    """
    weights, bias = np.zeros(BUCKETS, np.float32), -6.0
    squares = np.full(BUCKETS, start, np.float32)
    bias_squares = 1.0
    bags = []
    for text, label in sample:
        words, sentence_of = [], []
        number = 0
        for token in _TOKENS.findall(text.lower()):
            if token[0] in _BREAK:
                number += 1
            else:
                words.append(token.encode())
                sentence_of.append(number)
        if words:
            distinct = {w: i for i, w in enumerate(dict.fromkeys(words))}
            buckets, valid = word_features(list(distinct))
            rows_of = np.fromiter((distinct[w] for w in words), np.int64, len(words))
            _, dense = np.unique(sentence_of, return_inverse=True)
            bags.append((buckets, valid, rows_of, dense, int(label)))
    # A bucket met in few documents would only be learnt by heart.
    met = np.zeros(BUCKETS, np.int64)
    for buckets, valid, *_ in bags:
        met[np.unique(buckets[valid])] += 1
    bags = [(buckets, valid & (met[buckets] >= least), *rest) for buckets, valid, *rest in bags]
    rng = np.random.default_rng(seed)
    for epoch in range(epochs):
        step = rate * (1 - 0.8 * epoch / epochs)
        for i in rng.permutation(len(bags)):
            buckets, valid, rows_of, dense, label = bags[i]
            per_word = (weights[buckets] * valid).sum(axis=1)
            logit = bias + np.bincount(dense, per_word[rows_of])
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            whole = -np.expm1(-np.logaddexp(0, logit).sum())
            # The slope of the log likelihood by each sentence's logit.
            slope = lift * p * (1 - whole) / max(whole, 1e-6) if label else -p
            by_word = np.bincount(rows_of, slope[dense], minlength=len(buckets))
            active = np.abs(by_word) > 1e-5
            if active.any():
                ids = buckets[active][valid[active]]
                grads = np.repeat(by_word[active], valid[active].sum(axis=1))
                found, at = np.unique(ids, return_inverse=True)
                total = np.bincount(at, grads) - decay * np.abs(slope).max() * weights[found]
                squares[found] += total**2
                # Evidence only adds up: no number of harmless words in a sentence makes up for an insult.
                weights[found] = np.maximum(floor, weights[found] + step * total / np.sqrt(squares[found]))
            bias_slope = slope.sum()
            bias_squares += bias_slope**2
            bias += step * bias_slope / np.sqrt(bias_squares)
    return Model(weights, float(bias))


class _Words(dict):
    """Numbers for tokens, 0 for sentence ends, with the score of each word."""

    def __init__(self, model: Model, most: int = MOST_KNOWN):
        super().__init__()
        self.model, self.most = model, most
        self.scores, self.pending = np.zeros(1, np.float64), []

    def __missing__(self, token: str) -> int:
        if token[0] in _BREAK:
            number = 0
        else:
            number = len(self.scores) + len(self.pending)
            self.pending.append(token)
        self[token] = number
        return number

    def settle(self) -> None:
        if self.pending:
            new = self.model.word_scores([w.encode() for w in self.pending])
            self.scores = np.concatenate([self.scores, new])
            self.pending = []

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()
            self.scores = np.zeros(1, np.float64)


def _sentences(text: str):
    """Spans of the sentences of a text that have words, in order."""
    start = None
    for m in _TOKENS.finditer(text):
        if m.group()[0] in _BREAK:
            if start is not None:
                yield start, m.end()
            start = None
        else:
            start = m.start() if start is None else start
            end = m.end()
    if start is not None:
        yield start, end


def score(documents: DataFrame, model: Model, threshold: float = THRESHOLD, located: bool = True) -> DataFrame:
    """Add `toxic_score`, `toxic_pred` and, if wanted, `offending` to any table with a `text`.

    The whole text is read. `offending` has the span (in code points) and score of each sentence with a
    probability of a half or more, for documents predicted toxic; else it is empty. A null text or one without words has
    no sentence and scores 0. With no labels to learn from all scores are near 0. Equal texts get equal results;
    other columns are passed on, and columns of these names are replaced.
    """
    added = {"toxic_score": "double", "toxic_pred": "int"}
    if located:
        added["offending"] = "array<struct<start:int,end:int,score:double>>"
    columns = [c for c in documents.columns if c not in added]
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return map_rows(
        documents.select(*columns), _scorer(shared, threshold, located), ", ".join(f"{k} {v}" for k, v in added.items())
    )


def _scorer(shared, threshold: float, located: bool):
    state: dict = {}

    def sentence_scores(words: _Words, bias: float, text: str) -> np.ndarray:
        tokens = _TOKENS.findall(text.lower())
        ids = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
        words.settle()
        if not ids.any():
            return np.zeros(0)
        ends = ids == 0
        number = np.cumsum(ends) - ends
        sums = np.bincount(number, words.scores[ids])
        return bias + sums[np.bincount(number, ~ends) > 0]

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        model = shared.value
        words = state.setdefault("words", _Words(model))
        scores, spans = [], []
        for text in texts_of(batch):
            words.trim()
            logits = sentence_scores(words, model.bias, text)
            whole = float(-np.expm1(-np.logaddexp(0, logits).sum())) if len(logits) else 0.0
            scores.append(whole)
            found = []
            if located and whole >= threshold:
                for (start, end), logit in zip(_sentences(text), logits, strict=False):
                    if logit >= 0:
                        found.append({"start": start, "end": end, "score": float(1 / (1 + np.exp(-logit)))})
            spans.append(found)
        out = [pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())]
        if located:
            kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
            out.append(pa.array(spans, pa.list_(kind)))
        return out

    return run


def keep_clean(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents not predicted toxic, with their own columns, whatever their names."""

    def clean(docs: DataFrame) -> DataFrame:
        return score(docs, model, threshold, located=False).where(F.col("toxic_pred") == 0).select(*docs.columns)

    return keeping(documents, ("toxic_score", "toxic_pred", "offending"), clean)
