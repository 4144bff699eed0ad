"""Quality classifier: supervised vectors of words, word pairs and character n-grams, averaged, under a softmax."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from clipcurate.llm.common import labelled_sample, map_rows, texts_of
from clipcurate.llm.subword import Model, Space, WordRows, document_sums, train

SPACE = Space(low=2, high=4, buckets=1 << 17, pair_weight=4.0)
#: Bound of the training sample: rows of each label, and characters of a row.
SAMPLE_ROWS = 1_500
SAMPLE_CHARS = 20_000


def terms_of(text: str) -> list[str]:
    """Words as written, with their punctuation and in their order."""
    return text.split()


def fit(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, max_chars: int = SAMPLE_CHARS) -> Model:
    """Learn `labels.quality` from rows outside the held-out fold, up to `rows` of each label value."""
    sample = labelled_sample(documents, labels, "quality", rows, max_chars)
    examples = [([w.encode() for w in terms_of(text)], int(label)) for text, label in sample]
    return train(examples, SPACE, epochs=8)


def score(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Add `quality_score` (probability of label 1) and `quality_pred` to any table with a `text`.

    The whole text is read. A null or empty text has no vectors and gets the score of the bias alone. Without
    both label values to learn from, every score is the share of the one label seen (0.5 if none). Equal texts
    get equal scores; other columns are passed on, and columns of the two names are replaced.
    """
    columns = [c for c in documents.columns if c not in ("quality_score", "quality_pred")]
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return map_rows(documents.select(*columns), _scorer(shared, threshold), "quality_score double, quality_pred int")


def _scorer(shared, threshold: float):
    state: dict = {}

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        model = shared.value
        rows = state.setdefault("rows", WordRows(model))
        texts, scores = texts_of(batch), []
        if len(model.classes) < 2:
            scores = [float(model.classes[0]) if model.classes else 0.5] * len(texts)
        else:
            for start in range(0, len(texts), 500):
                sums = document_sums(rows, [terms_of(t) for t in texts[start : start + 500]])
                scores += model.probabilities(sums)[:, model.classes.index(1)].tolist()
        return [pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())]

    return run
