"""Growing a vocabulary by the characters of a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clipcurate.functions.text import GUJARATI
from clipcurate.operators.vocab import distinct_characters, extend_vocab


def grow_vocabulary(
    texts: DataFrame,
    vocab: DataFrame,
    column: str = "text",
    script: tuple[int, int] | None = GUJARATI,
) -> DataFrame:
    return extend_vocab(vocab, distinct_characters(texts, column, script))
