"""CSV manifests with line breaks inside texts, read by many tasks.

Whether a line starts a record depends on all quotes before it in its file. Each split counts its own quotes; the sums
before a split, one row per split, say whether it starts inside a text. Records are put together inside their split;
only the pieces at its two ends are joined over splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clipcurate.session import written

_CSV = {"escape": '"'}


def _joined(at: Column, text: Column) -> Column:
    parts = F.sort_array(F.collect_list(F.struct(at.alias("at"), text.alias("text"))))
    return F.array_join(F.transform(parts, lambda p: p["text"]), "\n")


def quoted_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their split, their place in it and their quotes; a line belongs to the split it starts in."""
    lines = spark.read.option("lineSep", "\n").text(path)
    value = F.regexp_replace("value", "\r$", "")
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        value.alias("value"),
        F.regexp_count("value", F.lit('"')).alias("quotes"),
    )


def split_parities(lines: DataFrame) -> DataFrame:
    """`(file, block, inside)`: does the first line of a split lie inside a quoted text? One row per split."""
    sums = lines.groupBy("file", "block").agg(F.sum("quotes").alias("n"))
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = F.sum("n").over(upto)
    return sums.select(
        "file", "block", ((after - F.col("n")) % 2 == 1).alias("inside"), (after % 2 == 1).alias("open")
    )


def records(lines: DataFrame, parities: DataFrame) -> DataFrame:
    """`(record, header)`: whole records, and whether each is the first of its file.

    Lines of a split are shuffled together once; a split has a fixed size, so no group grows with the file. What is
    joined over splits are at most two pieces of a record per split.
    """
    before = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    through = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    odd = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2) == 1
    # One row per split, as many as the driver plans itself.
    placed = lines.join(F.broadcast(parities), ["file", "block"]).withColumn("starts", odd == F.col("inside"))
    pieces = (
        placed.withColumn("no", F.count_if("starts").over(through))
        .groupBy("file", "block", "no")
        .agg(_joined(F.col("pos"), F.col("value")).alias("record"), F.sum("quotes").alias("quotes"))
        .withColumn("header", (F.col("block") == 0) & (F.col("no") == 1))
    )
    cut = (F.col("no") == 0) | (F.col("quotes") % 2 == 1)
    in_order = Window.partitionBy("file").orderBy("block", "no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = (
        pieces.where(cut)
        .withColumn("chain", F.count_if(F.col("no") > 0).over(in_order))
        .groupBy("file", "chain")
        .agg(_joined(F.struct("block", "no"), F.col("record")).alias("record"), F.bool_or("header").alias("header"))
    )
    return pieces.where(~cut).select("record", "header").unionByName(whole.select("record", "header"))


def read_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, by the header of the first file; every file starts with a header.

    Quotes have to stand around whole fields, doubled inside, as in RFC 4180. A file with an odd number of quotes is
    an error. Empty lines are no records, short records end in nulls, a line break inside a text comes back as one
    newline. A file without rows gives none.
    """
    names = spark.read.options(header=True, multiLine=True, **_CSV).csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    lines = quoted_lines(spark, path)
    parities = written(split_parities(lines), "parities")
    last = parities.groupBy("file").agg(F.max_by("open", "block").alias("open")).where("open").first()
    if last is not None:
        raise ValueError(f"{last['file']} ends inside a quoted text")
    rows = records(lines, parities).where((F.col("record") != "") & ~F.col("header"))
    return rows.select(F.from_csv("record", F.lit(schema.simpleString()), _CSV).alias("row")).select("row.*")
