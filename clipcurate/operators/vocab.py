"""Character inventories, vocabulary growth and character encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipcurate.functions.text import characters, only_script

# Every table of single characters has at most this many rows.
UNICODE_SIZE = 0x110000


def character_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    """`(token, n)` for every character; map tasks send one partial count per character."""
    chars = texts.select(F.explode(characters(F.col(column))).alias("token"))
    return chars.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def distinct_characters(
    texts: DataFrame, column: str = "text", script: tuple[int, int] | None = None
) -> DataFrame:
    """`(token)`, optionally of one code-point range; repeats are dropped inside each text first."""
    text = F.col(column) if script is None else only_script(F.col(column), *script)
    chars = texts.select(F.explode(F.array_distinct(characters(text))).alias("token"))
    return chars.distinct()


def new_characters(chars: DataFrame, vocab: DataFrame) -> DataFrame:
    return chars.select("token").join(vocab.select("token"), "token", "left_anti")


def vocab_stats(vocab: DataFrame) -> DataFrame:
    return vocab.agg(
        F.max("token_id").alias("max_token_id"), F.count(F.lit(1)).alias("vocab_size")
    )


def extend_vocab(vocab: DataFrame, chars: DataFrame) -> DataFrame:
    """Known tokens keep their ids; new characters get dense ids after the largest, by code point.

    The window has no partition: its rows are distinct characters, UNICODE_SIZE at most.
    """
    top = vocab.agg(F.coalesce(F.max("token_id"), F.lit(-1)))
    position = F.row_number().over(Window.orderBy(F.ascii("token")))
    added = new_characters(chars.where(F.length("token") == 1).distinct(), vocab).select(
        "token", (top.scalar() + position).cast("int").alias("token_id")
    )
    known = vocab.select("token", "token_id", F.lit(False).alias("added"))
    return known.unionByName(added.withColumn("added", F.lit(True)))


def char_id_table(vocab: DataFrame, unknown_id: int) -> Column:
    """Token ids by code point as one constant array, so that a lookup is a plain index.

    Only single characters can be looked up, and they are folded to one row each, so the driver receives
    UNICODE_SIZE rows at most and the array ends at the largest code point in use. Of several ids of a
    character the smallest counts.
    """
    rows = (
        vocab.where(F.length("token") == 1)
        .groupBy(F.ascii("token").alias("code"))
        .agg(F.min("token_id").alias("token_id"))
        .collect()
    )
    ids = [unknown_id] * (max((r.code for r in rows), default=0) + 1)
    for r in rows:
        ids[r.code] = r.token_id
    return F.split(F.lit(",".join(map(str, ids))), ",").cast("array<int>")


def encode_characters(text: Column, id_table: Column, unknown_id: int) -> Column:
    """Token ids of a text, one per character, computed in the row: nothing is exploded or shuffled."""
    return F.transform(
        characters(text), lambda c: F.coalesce(F.get(id_table, F.ascii(c)), F.lit(unknown_id))
    )
