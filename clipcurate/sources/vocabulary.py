"""Vocabulary documents."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipcurate.schemas import VOCABULARY_DOCUMENT
from clipcurate.sinks.vocabulary import CLOSING, OPENING, SEPARATOR


def read_vocabulary_lines(spark: SparkSession, path: str) -> DataFrame:
    """`(token, token_id)` of a document as the sink writes it, however many files it is spread over."""
    line = F.regexp_replace("value", r"^" + re.escape(OPENING), "")
    line = F.regexp_replace(line, r"(,|" + re.escape(CLOSING) + r")$", "")
    entry = F.from_json(F.concat(F.lit("{"), line, F.lit("}")), "map<string,int>")
    return spark.read.text(path, lineSep=SEPARATOR).select(F.explode(entry).alias("token", "token_id"))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """`(token, token_id)` of tokenizer documents of one file each. The map type is given, so tokens stay rows."""
    doc = F.from_json("value", VOCABULARY_DOCUMENT)
    return (
        spark.read.text(path, wholetext=True)
        .select(doc.alias("doc"))
        .select(F.explode("doc.model.vocab").alias("token", "token_id"))
    )
