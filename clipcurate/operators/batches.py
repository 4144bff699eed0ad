"""Batches of samples of like length, under a limit of padded tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipcurate.config import EPOCHS, GRADIENT_ACCUMULATION
from clipcurate.operators.ordering import number_rows

# Samples of one batch differ by less than this in length.
BAND_WIDTH = 32


def batch_plan(samples: DataFrame, max_tokens: int, width: int = BAND_WIDTH) -> DataFrame:
    """`(id, length, batch_no, batch_rows, batch_length, padding_share)` for samples with an `id` and a `length`.

    Samples are taken in order of length and id, which have to be unique together, and cut into batches inside bands
    of `width` lengths. A batch has as many rows as fit in `max_tokens` if each is as long as its band allows, and one
    if not even one fits; only the last batch of a band has fewer. Batches are numbered from 0 by length. The padding
    share of a sample is the part of its row that is padding, 0 in a batch of empty samples. A null length counts as 0.

    Numbers come from range partitions, so a length that a third of the samples have is split by id; the table of
    bands has one row per band, and a batch, which one task sees whole, never has more than `max_tokens` rows.
    """
    length = F.coalesce(F.col("length"), F.lit(0)).cast("long")
    rows = samples.select("id", length.alias("length"))
    band = F.expr(f"(greatest(length, 1) - 1) div {width}")
    numbered = number_rows(rows, "length", "id").withColumn("band", band)
    capacity = F.greatest(F.expr(f"{max_tokens} div ((band + 1) * {width})"), F.lit(1))
    bands = numbered.groupBy("band").agg(F.min("row_no").alias("first"), F.count(F.lit(1)).alias("n"))
    bands = bands.withColumn("capacity", capacity).withColumn("batches", F.expr("(n + capacity - 1) div capacity"))
    # One row per band: as many as the longest sample has widths.
    before = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.withColumn("before", F.coalesce(F.sum("batches").over(before), F.lit(0)))
    batch = F.col("before") + F.expr("(row_no - first) div capacity")
    placed = numbered.join(bands.drop("n", "batches"), "band").withColumn("batch_no", batch)
    together = Window.partitionBy("batch_no")
    return (
        placed.withColumn("batch_rows", F.count(F.lit(1)).over(together))
        .withColumn("batch_length", F.max("length").over(together))
        .select("id", "length", "batch_no", "batch_rows", "batch_length", _padding().alias("padding_share"))
    )


def _padding():
    share = (F.col("batch_length") - F.col("length")).cast("double") / F.col("batch_length")
    return F.when(F.col("batch_length") == 0, F.lit(0.0)).otherwise(share)


def batch_summary(
    plan: DataFrame, grad_accum: int = GRADIENT_ACCUMULATION, epochs: int = EPOCHS
) -> DataFrame:
    """One row: samples, batches, tokens, padded tokens, optimizer steps of an epoch and of a whole run.

    The last step of an epoch may have fewer batches. Without samples all counts are 0.
    """
    counts = plan.agg(
        F.count(F.lit(1)).alias("samples"),
        F.coalesce(F.max("batch_no") + 1, F.lit(0)).alias("batches"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum("batch_length"), F.lit(0)).alias("padded_tokens"),
    )
    steps = F.expr(f"(batches + {grad_accum} - 1) div {grad_accum}")
    return counts.withColumn("steps", steps).withColumn("run_steps", F.col("steps") * F.lit(epochs).cast("long"))
