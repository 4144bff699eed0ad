"""Clip tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipcurate.functions.names import default_speaker
from clipcurate.schemas import CLEAN_CLIP, RAW_CLIP
from clipcurate.session import FILE_SCHEME, absolute_root

_ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def _placed(clips: DataFrame, path: str) -> DataFrame:
    """Clips with their place in the source: `src_file`, `src_row`.

    The file is named by its path below the scanned folder, as writers give files of different partition folders
    the same name. A scanned single file has its bare name.
    """
    root = absolute_root(clips.sparkSession, path)
    file = F.regexp_replace(F.col("_metadata.file_path"), FILE_SCHEME, "/")
    below = F.when(F.startswith(file, F.lit(root + "/")), F.substr(file, F.lit(len(root) + 2)))
    return clips.select(
        "*",
        F.coalesce(below, F.regexp_extract(file, "([^/]*)$", 1)).alias("src_file"),
        F.col("_metadata.row_index").alias("src_row"),
    )


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return _placed(spark.read.schema(RAW_CLIP).parquet(path), path)


def stream_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw clips of a folder that files are added to."""
    return _placed(spark.readStream.schema(RAW_CLIP).parquet(path), path)


def read_clean(spark: SparkSession, path: str, language: str | None = None) -> DataFrame:
    """Curated clips; they skip every filter but the language."""
    clips = spark.read.schema(CLEAN_CLIP).parquet(path)
    if language is not None:
        clips = clips.where(F.col("language") == language)
    return clips.withColumn(
        "speaker_id", F.coalesce(F.col("speaker_id"), default_speaker(F.col("language")))
    )


def clean_exists(spark: SparkSession, path: str, language: str) -> bool:
    """Is there a curated result for this language? A missing or empty folder is a no."""
    try:
        clips = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in _ABSENT:
            return False
        raise
    return not clips.where(F.col("language") == language).limit(1).isEmpty()
