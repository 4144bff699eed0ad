"""Language identification by averaged hashed subword embeddings under a calibrated linear softmax."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcurate.llm.common import give_back, keeping, labelled_sample, map_rows, texts_of
from clipcurate.llm.subword import Model, Space, WordRows, document_sums, leads, train

UNKNOWN = "und"
SPACE = Space(low=2, high=4, buckets=1 << 16)
#: Bound of the training sample: rows of each language, and characters of a row.
SAMPLE_ROWS = 300
SAMPLE_CHARS = 20_000
#: Calibration of rejection: at most so many languages are left out in turn, with so many rows of each language, and the
#: share of accepted answers that shall be right when as many texts are of no learnt language as are of one.
LEFT_OUT, LEFT_OUT_ROWS, PRECISION = 8, 100, 0.95

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def fit(documents: DataFrame, rows: int = SAMPLE_ROWS, max_chars: int = SAMPLE_CHARS) -> Model:
    """Learn from the non-null `lang` of documents outside the held-out fold, up to `rows` of each language."""
    sample = labelled_sample(documents, documents, "lang", rows, max_chars)
    examples = [(Counter(w.encode() for w in words_of(text)), lang) for text, lang in sample]
    model = learn([e for e in examples if e[0]])
    del sample, examples
    give_back()
    return model


def learn(examples: list[tuple[Counter, str]]) -> Model:
    """The model of (words, language) examples, with its limit of rejection.

    Models that each lack one of the languages are asked for that language: what they answer is wrong, whatever it is.
    The limit is the lead that all but `1 - PRECISION` of these answers stay below, as long as no more right answers
    of the rows kept apart fall below it than `subword.KEEP` allows. With two languages there is nothing to leave out,
    and with fewer nothing to choose from.
    """
    model = train(examples, SPACE, epochs=6)
    few: dict = {}
    for example in examples:
        of_language = few.setdefault(example[1], [])
        if len(of_language) < LEFT_OUT_ROWS:
            of_language.append(example)
    wrong = []
    for absent in sorted(few, key=str)[:LEFT_OUT] if len(few) > 2 else []:
        lacking = train([e for lang, own in few.items() if lang != absent for e in own], SPACE, epochs=6)
        for words, _ in few[absent]:
            ids, shares = SPACE.features(words)
            wrong.append(leads(shares @ lacking.logits[ids] + lacking.bias))
    if wrong:
        model.reject_below = min(model.reject_below, float(np.quantile(wrong, PRECISION)))
    return model


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """Add `lang_pred`, `lang_score` and `lang_rejected` to any table with a `text`.

    The whole text is read. A text that is null or has no letter is `und`, scores 0 and is rejected. Another text
    gets the likeliest learnt language and its calibrated probability; of two equally likely ones the one that sorts
    first. It is rejected when that language leads the next by less than the limit of `learn`, as texts of no learnt
    language do. With fewer than two languages to learn from, every text with a letter gets the one language, and
    none is rejected (or `und`, rejected). Equal texts get equal results, an empty table an empty one; other columns
    are passed on, and columns of the three names are replaced.
    """
    columns = [c for c in documents.columns if c not in ("lang_pred", "lang_score", "lang_rejected")]
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return map_rows(
        documents.select(*columns), _identifier(shared), "lang_pred string, lang_score double, lang_rejected boolean"
    )


def _identifier(shared):
    state: dict = {}

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        model = shared.value
        rows = state.setdefault("rows", WordRows(model))
        names, scores, rejected = [], [], []
        texts = texts_of(batch)
        for start in range(0, len(texts), 500):
            documents = [words_of(t) for t in texts[start : start + 500]]
            sums = document_sums(rows, documents)
            best = model.probabilities(sums)
            several = len(model.classes) > 1
            lead = leads(model.scores(sums)) if several else np.full(len(documents), np.inf)
            for words, p, ahead in zip(documents, best, lead, strict=True):
                if not words or not model.classes:
                    names.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                else:
                    at = int(np.argmax(p))
                    names.append(str(model.classes[at])), scores.append(float(p[at]))
                    rejected.append(bool(ahead < model.reject_below))
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]

    return run


def keep_identified(documents: DataFrame, model: Model) -> DataFrame:
    """The documents that `identify` does not reject, with their own columns, whatever their names."""

    def known(docs: DataFrame) -> DataFrame:
        return identify(docs, model).where(~F.col("lang_rejected")).select(*docs.columns)

    return keeping(documents, ("lang_pred", "lang_score", "lang_rejected"), known)
