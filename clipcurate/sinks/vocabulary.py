"""Vocabulary documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcurate.operators.ordering import number_rows

# What stands around the entries of a document.
OPENING, CLOSING = '{"model":{"vocab":{', "}}}"
# White space that JSON allows between entries and never holds unescaped within one.
SEPARATOR = "\t"

# The most tokens of a document that is a single row. Written documents have no such limit.
MAX_DOCUMENT_TOKENS = 2_000_000


def vocabulary_document(vocab: DataFrame) -> DataFrame:
    """One row `value` with the whole vocabulary, ordered by id, for a vocabulary that fits into a row."""
    if vocab.limit(MAX_DOCUMENT_TOKENS + 1).count() > MAX_DOCUMENT_TOKENS:
        raise ValueError("too many tokens for one row; write the vocabulary or take its lines")
    entries = F.sort_array(F.collect_list(F.struct("token_id", "token")))
    as_map = F.map_from_entries(F.transform("_e", lambda e: F.struct(e["token"], e["token_id"])))
    doc = F.to_json(F.struct(F.struct(as_map.alias("vocab")).alias("model")))
    return vocab.agg(entries.alias("_e")).select(doc.alias("value"))


def vocabulary_lines(vocab: DataFrame) -> DataFrame:
    """The lines of one JSON document, `(row_no, value)`: an entry each, ordered by id, between its two ends.

    Put together in order they are the document. No task and no row holds more than its lines. A table without
    entries gives no lines.
    """
    rows = number_rows(vocab.select("token_id", "token"), "token_id", "token")
    last = rows.agg(F.max("row_no"))
    key = F.expr("""substring(to_json(struct(token)), 10, length(to_json(struct(token))) - 10)""")
    entry = F.concat(key, F.lit(":"), F.col("token_id").cast("string"))
    start = F.when(F.col("row_no") == 1, OPENING).otherwise("")
    end = F.when(F.col("row_no") == last.scalar(), CLOSING).otherwise(",")
    return rows.select("row_no", F.concat(start, entry, end).alias("value"))


def write_vocabulary(vocab: DataFrame, path: str) -> None:
    """Text files that put together in the order of their names are the document, of any size."""
    lines = vocabulary_lines(vocab).repartitionByRange("row_no").sortWithinPartitions("row_no")
    lines.select("value").write.mode("overwrite").text(path, lineSep=SEPARATOR)
