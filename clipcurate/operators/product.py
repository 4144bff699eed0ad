"""Pairing every row with every row of a second table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcurate.operators.ordering import number_rows

# Rows of the second table that travel together as one array.
BLOCK_ROWS = 1_000
SALTS = 64


def with_each(
    left: DataFrame, right: DataFrame, *right_key: str | Column, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Every pair of a left and a right row; the whole product is the wanted result.

    A right side of at most `block_rows` rows becomes one array that each left row unfolds where it is, with
    no join. A larger one is cut into such blocks, and left rows meet the blocks by an equi-join on the
    block number and a salt of their columns, so that no task gets more than its share of left rows. Left
    rows should differ from one another, by a row number for instance.
    """
    item = F.struct(*right.columns)
    unfolded = [F.col(f"_item.{c}").alias(c) for c in right.columns]
    if right.limit(block_rows + 1).count() <= block_rows:
        items = right.agg(F.collect_list(item).alias("_items"))
        return left.select("*", F.explode(items.scalar()).alias("_item")).select(
            *left.columns, *unfolded
        )
    blocks = (
        number_rows(right, *(right_key or right.columns), name="_row_no")
        .groupBy(F.call_function("div", F.col("_row_no") - 1, F.lit(block_rows)).alias("_block"))
        .agg(F.collect_list(item).alias("_items"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    last = blocks.agg(F.max("_block").alias("last"))
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int"))
    return (
        salted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last.scalar())))
        .join(blocks, ["_block", "_salt"])
        .select(*left.columns, F.explode("_items").alias("_item"))
        .select(*left.columns, *unfolded)
    )
