"""File names, ids and manifest lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipcurate.config import SPEAKER_PREFIX
from clipcurate.functions.text import strip_outer_quotes

# Path, header and file-name formats that readers of the written files expect.
WAV_FOLDER = "wavs/"
WAV_SUFFIX = ".wav"
CSV_HEADER = "file_name,transcription,duration_seconds"
SAMPLE_FORMAT = "%s_sample_%03d.wav"
SHARD_FORMAT = "shard_%05d"


def wav_path(clip_id: Column) -> Column:
    return F.concat(F.lit(WAV_FOLDER), clip_id, F.lit(WAV_SUFFIX))


def path_stem(path: Column) -> Column:
    """File name without folders and without its last suffix; a leading dot starts no suffix."""
    name = F.regexp_extract(path, "([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")


def absolute_path(root: str, relative: Column) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), relative)


def default_speaker(language: Column) -> Column:
    return F.concat(F.lit(SPEAKER_PREFIX), language)


def seconds_text(ms: Column) -> Column:
    """Milliseconds as decimal seconds: no trailing zeros, at least one decimal place."""
    whole = F.call_function("div", ms, F.lit(1000)).cast("string")
    part = F.lpad((ms % 1000).cast("string"), 3, "0")
    trimmed = F.regexp_replace(part, "0{1,2}$", "")
    return F.concat(whole, F.lit("."), trimmed)


def csv_line(path: Column, text: Column, ms: Column) -> Column:
    """Only the text is quoted, always. Quotes around a path are added where it needs them."""
    doubled = lambda c: F.replace(c, F.lit('"'), F.lit('""'))
    quoted = lambda c: F.concat(F.lit('"'), doubled(c), F.lit('"'))
    safe_path = F.when(path.rlike('[",\r\n]'), quoted(path)).otherwise(path)
    return F.concat_ws(",", safe_path, quoted(text), seconds_text(ms))


def pair_line(key: Column, value: Column) -> Column:
    return F.concat_ws(" ", key, value)


def pipe_line(path: Column, text: Column, strip_quotes: bool = True) -> Column:
    body = strip_outer_quotes(text) if strip_quotes else text
    return F.concat_ws("|", path, body, body)


def sample_file(ref_name: Column, sample_no: Column) -> Column:
    """At least three digits; wider numbers are kept whole."""
    return F.format_string(SAMPLE_FORMAT, ref_name, sample_no)


def shard_name(shard_id: Column) -> Column:
    return F.format_string(SHARD_FORMAT, shard_id)
