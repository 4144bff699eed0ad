"""Batch generation: which texts are spoken by which voices, and how it went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipcurate.functions.names import sample_file
from clipcurate.operators.ordering import number_rows
from clipcurate.operators.product import with_each

# Fixed values: (preset, exaggeration, cfg weight).
PRESETS = (
    ("stable", 0.3, 0.3),
    ("balanced", 0.5, 0.5),
    ("expressive", 0.7, 0.3),
    ("no_voice_match", 0.5, 0.0),
)
DEFAULT_PRESET = PRESETS[1]


def presets(spark: SparkSession, rows: tuple = (DEFAULT_PRESET,)) -> DataFrame:
    return spark.createDataFrame(
        list(rows), "preset string, exaggeration double, cfg_weight double"
    )


def generation_plan(
    texts: DataFrame,
    references: DataFrame,
    settings: DataFrame,
    *text_order: str | Column,
) -> DataFrame:
    """Every text for every reference voice and setting.

    The sample number of a text is its place in the text list, the same for each voice, so texts are
    numbered once before they are paired. The files of the default setting lie in the output folder, those of any
    other setting in a folder of its name, so no file is written twice and a further setting renames nothing.
    """
    numbered = number_rows(texts.select("text", *text_order), *text_order, name="sample_no")
    per_voice = with_each(
        numbered.select("sample_no", "text"), references.select("ref_name", "ref_path"), "ref_name"
    )
    folder = F.when(F.col("preset") == DEFAULT_PRESET[0], "").otherwise(F.concat("preset", F.lit("/")))
    return with_each(per_voice, settings, "preset").withColumn(
        "file", F.concat(folder, sample_file(F.col("ref_name"), F.col("sample_no")))
    )


def generation_summary(log: DataFrame) -> DataFrame:
    """Attempts, successes and seconds per reference voice, from whole hundredths of a second."""
    hundredths = F.sum(F.round(F.col("duration") * 100).cast("long"))
    return log.groupBy("ref_name").agg(
        F.count_if(F.col("status") == "ok").alias("succeeded"),
        F.count(F.lit(1)).alias("attempted"),
        (hundredths / F.lit(100.0)).alias("total_seconds"),
    )
