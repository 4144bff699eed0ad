"""Row numbers, prefixes and top-k lists without a one-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipcurate.session import written

# Above these sizes a prefix or a top-k list is cut from distributed row numbers instead.
PREFIX_IN_MEMORY = 10_000
TOP_K_IN_MEMORY = 1_000

_PARTITION_SHIFT = 33
_POSITION_MASK = (1 << _PARTITION_SHIFT) - 1


def number_rows(df: DataFrame, *order: str | Column, name: str = "row_no") -> DataFrame:
    """Add a dense row number from 1 in `order`, which has to be unique.

    The rows are range-partitioned, so a value shared by many rows is split by the later order columns,
    and written once with their position inside the partition. Partition sizes are then turned into
    offsets; that side has one row per partition. Pass narrow rows, as everything in `df` is written, and
    a table rather than a long plan, as a range partitioning reads its input once more to sample it.
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    rows = written(ranged, "numbered")
    part = F.shiftright("_slot", _PARTITION_SHIFT)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    position = F.col("_slot").bitwiseAND(F.lit(_POSITION_MASK))
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position + 1)
        .select(*df.columns, name)
    )


def take_first(df: DataFrame, n: int | None, *order: str | Column) -> DataFrame:
    """The first n rows in `order`; None and 0 mean no limit."""
    if not n:
        return df
    if n <= PREFIX_IN_MEMORY:
        return df.orderBy(*order).limit(n)
    return number_rows(df, *order, name="_row_no").where(F.col("_row_no") <= n).drop("_row_no")


def top_per_group(
    df: DataFrame, group: str, k: int, *order: str | Column, rank: str = "rank"
) -> DataFrame:
    """The first k rows of each group in `order`, with their rank.

    For a small k Spark cuts each map task's rows to k per group before the shuffle. A large k is read off
    global row numbers, so no group is ever sorted by one task.
    """
    if k <= TOP_K_IN_MEMORY:
        ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
        return ranked.where(F.col(rank) <= k)
    numbered = number_rows(df, group, *order, name="_row_no")
    firsts = numbered.groupBy(group).agg(F.min("_row_no").alias("_first"))
    return (
        numbered.join(firsts, group)
        .withColumn(rank, (F.col("_row_no") - F.col("_first") + 1).cast("int"))
        .where(F.col(rank) <= k)
        .drop("_row_no", "_first")
    )
