"""Text manifests. Each is a folder of part files whose lines run on in id order."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipcurate.functions import names
from clipcurate.session import absolute_root, delete_folder, folder_exists, replace_folder

_POSITION_MASK = (1 << 33) - 1


# The file names that readers of these manifests look for.
FILES = {"csv": "metadata.csv", "scp": "wav.scp", "text": "text", "speakers": "utt2spk"}
MANIFESTS = tuple(FILES)
_HEADERS = {"csv": names.CSV_HEADER}


def csv_line_of() -> Column:
    return names.csv_line(F.col("wav_path"), F.col("text"), F.col("duration_ms"))


def scp_line_of(root: str) -> Column:
    folder = F.concat(F.lit(root.rstrip("/") + "/"), F.col("language"), F.lit("/"))
    return names.pair_line(F.col("id"), F.concat(folder, F.col("wav_path")))


def text_line_of() -> Column:
    return names.pair_line(F.col("id"), F.col("text"))


def speaker_line_of() -> Column:
    return names.pair_line(F.col("id"), F.col("speaker"))


def csv_lines(manifest: DataFrame) -> DataFrame:
    return manifest.select("id", "language", csv_line_of().alias("line"))


def wav_scp_lines(manifest: DataFrame, root: str) -> DataFrame:
    return manifest.select("id", "language", scp_line_of(root).alias("line"))


def text_lines(manifest: DataFrame) -> DataFrame:
    return manifest.select("id", "language", text_line_of().alias("line"))


def speaker_lines(manifest: DataFrame) -> DataFrame:
    return manifest.select("id", "language", speaker_line_of().alias("line"))


def pipe_lines(manifest: DataFrame, strip_quotes: bool = True) -> DataFrame:
    line = names.pipe_line(F.col("wav_path"), F.col("text"), strip_quotes)
    return manifest.select("id", "language", line.alias("line"))


def _first_of_file() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)) == 0


def write_lines(lines: DataFrame, path: str, header: str | None = None) -> None:
    """Sorted by id; every part file starts with the header, as Spark's CSV reader expects, also one without rows."""
    if header is not None and lines.isEmpty():
        lines.sparkSession.createDataFrame([(header,)], "value string").write.mode("overwrite").text(path)
        return
    ordered = lines.orderBy("id")
    line = F.col("line")
    if header is not None:
        line = F.when(_first_of_file(), F.concat(F.lit(header + "\n"), line)).otherwise(line)
    ordered.select(line.alias("value")).write.mode("overwrite").text(path)


def _ranged(rows: DataFrame) -> DataFrame:
    """Rows of all manifests in id order with the line of each, `(name, slot, line)`; one range exchange for all."""
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id")
    slotted = ordered.withColumn("slot", F.monotonically_increasing_id())
    first = F.col("slot").bitwiseAND(F.lit(_POSITION_MASK)) == 0
    lines = []
    for name in MANIFESTS:
        line = F.col(f"lines.{name}")
        if name in _HEADERS:
            line = F.when(first, F.concat(F.lit(_HEADERS[name] + "\n"), line)).otherwise(line)
        lines.append(F.struct(F.lit(FILES[name]).alias("name"), line.alias("line")))
    return slotted.select("slot", F.inline(F.array(*lines))).sortWithinPartitions("name", "slot")


def write_manifests(manifest: DataFrame, root: str, language: str) -> dict[str, str]:
    """The four manifests of one language, under `root/language`; returns their paths.

    They are written side by side by one job from rows sorted once, into a hidden folder, and put in their places when
    all are complete: a job that fails leaves the older ones as they were.
    """
    spark = manifest.sparkSession
    rows = manifest.where(F.col("language") == language)
    folder = f"{root.rstrip('/')}/{language}"
    scp_root = absolute_root(spark, root)
    lines = {
        "csv": csv_line_of(), "scp": scp_line_of(scp_root), "text": text_line_of(), "speakers": speaker_line_of(),
    }
    lined = rows.select("id", F.struct(*[line.alias(name) for name, line in lines.items()]).alias("lines"))
    paths = {file: f"{folder}/{file}" for file in FILES.values()}
    staged = f"{folder}/.manifests-{uuid.uuid4().hex}"
    try:
        _ranged(lined).select("line", "name").write.partitionBy("name").text(staged)
        for name, file in FILES.items():
            part = f"{staged}/name={file}"
            if not folder_exists(spark, part):
                # No clip: a file with the header alone, or an empty one.
                header = [(_HEADERS[name],)] if name in _HEADERS else []
                spark.createDataFrame(header, "value string").coalesce(1).write.text(part)
        for file, path in paths.items():
            replace_folder(spark, f"{staged}/name={file}", path)
    finally:
        delete_folder(spark, staged)
    return paths


def csv_to_pipe(csv_manifest: DataFrame, strip_quotes: bool = True) -> DataFrame:
    """Rows of a CSV manifest as pipe-manifest lines."""
    line = names.pipe_line(F.col("file_name"), F.col("transcription"), strip_quotes)
    return csv_manifest.select(F.col("file_name").alias("id"), line.alias("line"))
