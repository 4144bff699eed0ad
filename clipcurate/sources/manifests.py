"""Text manifests, text lists and file listings."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipcurate.functions.names import WAV_FOLDER, WAV_SUFFIX, path_stem
from clipcurate.functions.text import strip_whitespace
from clipcurate.sources.split_csv import read_split_csv

# The audio file types that count as a reference voice; case matters.
REFERENCE_GLOB = "*.{wav,mp3,flac}"


def read_csv_manifest(spark: SparkSession, path: str, multi_line: bool = True, split: bool = False) -> DataFrame:
    """Columns are found by their header names; a manifest without durations gets nulls.

    A quoted text may hold line breaks, for which Spark's reader gives a file to one task. `split=True` reads a large
    file by many tasks all the same, if its quotes follow RFC 4180. Manifests written here hold no line breaks and
    have many part files; `multi_line=False` splits them without looking at quotes.
    """
    if split:
        rows = read_split_csv(spark, path)
    else:
        rows = (
            spark.read.option("header", True)
            .option("escape", '"')
            .option("multiLine", multi_line)
            .csv(path)
        )
    seconds = F.col("duration_seconds") if "duration_seconds" in rows.columns else F.lit(None)
    return rows.select(
        "file_name", "transcription", seconds.cast("double").alias("duration_seconds")
    )


def read_pipe_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Lines with at least two fields; `raw` is the second, `normalized` the third if there is one."""
    parts = F.split(strip_whitespace(F.col("value")), r"\|")
    return (
        spark.read.text(path)
        .select(parts.alias("parts"))
        .where(F.size("parts") >= 2)
        .select(
            F.col("parts")[0].alias("wav_path"),
            F.col("parts")[1].alias("raw"),
            F.get("parts", F.lit(2)).alias("normalized"),
        )
    )


TEXT_ORDER = ("src_file", "src_block", "src_pos")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """One text per line, stripped; blank lines are dropped. Order the rows by TEXT_ORDER."""
    return (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("src_file"),
            F.col("_metadata.file_block_start").alias("src_block"),
            F.monotonically_increasing_id().alias("src_pos"),
            strip_whitespace(F.col("value")).alias("text"),
        )
        .where(F.col("text") != "")
    )


def choose_texts(
    spark: SparkSession,
    path: str | None = None,
    inline: list[str] | None = None,
    default: list[str] | None = None,
) -> DataFrame:
    """A file comes before an inline list, and that before the caller's default."""
    if path:
        return read_texts(spark, path)
    rows = [("", 0, i, text) for i, text in enumerate(inline or default or [])]
    return spark.createDataFrame(rows, "src_file string, src_block long, src_pos long, text string")


# Scheme and authority of a path, so that a qualified path can be compared with a given one.
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def _list_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """`(path, name, length)` of matching direct children of an absolute folder.

    Looked up as plain files: folders below may be partitioned tables, which are neither inferred nor kept.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
    )
    plain = re.sub(_SCHEME, "", folder).rstrip("/")
    name = F.regexp_extract("path", "([^/]+)$", 1)
    direct = F.regexp_replace("path", _SCHEME, "") == F.concat(F.lit(plain + "/"), name)
    return files.where(direct).select("path", name.alias("name"), "length")


def list_references(spark: SparkSession, folder: str) -> DataFrame:
    """Audio files directly in the folder. Only names and sizes are read, not contents."""
    files = _list_files(spark, folder, REFERENCE_GLOB)
    return files.select("path", "name", path_stem(F.col("name")).alias("ref_name"), "length").orderBy(
        "name"
    )


def list_wavs(spark: SparkSession, folder: str) -> DataFrame:
    """Existing WAV files as manifest paths."""
    files = _list_files(spark, folder, "*" + WAV_SUFFIX)
    return files.select(F.concat(F.lit(WAV_FOLDER), "name").alias("wav_path"), "length")
