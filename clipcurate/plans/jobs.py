"""Whole runs over folders: curate a language, pack all languages, generate speech."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipcurate.config import CurationConfig
from clipcurate.functions.audio import duration_ms, duration_seconds
from clipcurate.functions.names import wav_path
from clipcurate.functions.text import clean_text
from clipcurate.operators import pack
from clipcurate.operators.dedup import SOURCE_ORDER
from clipcurate.operators.funnel import clean_counts
from clipcurate.operators.verdict import in_languages, text_ok
from clipcurate.plans import generate as generation
from clipcurate.plans import packing
from clipcurate.plans.curate import CurationResult, Curator
from clipcurate.plans.hooks import Diarizer, Synthesizer, diarize_in_units, generate_in_units
from clipcurate.plans.progress import source_unit
from clipcurate.schemas import CLEAN_CLIP
from clipcurate.session import written
from clipcurate.sinks import tables
from clipcurate.sinks.text import write_manifests
from clipcurate.sinks.wav import export_wavs, wav_folder
from clipcurate.sources import clips as clip_source
from clipcurate.sources import manifests
from clipcurate.sources.ledger import read_ledger
from clipcurate.sources.wav import with_wav_info
from clipcurate.streaming.curate import curate_stream

# Folders of an output root.
LEDGER_FOLDER = "ledger"
STATS_FOLDER = "stats"
LOG_FOLDER = "generation_log"
MISSING_FOLDER = "missing"
PROGRESS_FOLDER = "progress"
ERRORS_FOLDER = "wav_errors"


def clip_index(raw: DataFrame) -> DataFrame:
    """Narrow rows of raw clips: everything the filters need, and no audio."""
    return with_wav_info(raw).select(
        "id",
        "language",
        "text",
        "frames",
        F.col("audio.sampling_rate").alias("sampling_rate"),
        "src_file",
        "src_row",
    )


def with_headers(rows: DataFrame, clips: DataFrame, config: CurationConfig) -> DataFrame:
    """New clips with the frames and rates of their audio, read for those whose text passes.

    Only the files that hold such clips are read. Their names come to the driver, as they do for any scan.
    """
    rows = written(rows, "new-clips")
    passing = rows.withColumn("clean_text", clean_text(F.col("text"))).where(text_ok(config))
    files = [r[0] for r in passing.select("src_file").distinct().collect()]
    headers = clip_index(clips.where(F.col("src_file").isin(*files))).select(*SOURCE_ORDER, "frames", "sampling_rate")
    wanted = headers.join(passing.select(*SOURCE_ORDER), list(SOURCE_ORDER), "left_semi")
    return rows.join(wanted, list(SOURCE_ORDER), "left").select(*rows.columns, "frames", "sampling_rate")


def clean_manifest(clean: DataFrame) -> DataFrame:
    """Curated clips in the shape of kept clips; durations come from the audio again."""
    frames, rate = F.col("frames"), F.col("audio.sampling_rate")
    return with_wav_info(clean).select(
        "id",
        "language",
        wav_path(F.col("id")).alias("wav_path"),
        "text",
        F.col("speaker_id").alias("speaker"),
        duration_seconds(frames, rate).alias("duration"),
        duration_ms(frames, rate).alias("duration_ms"),
        "cps",
    )


def curate_language(
    spark: SparkSession,
    raw_path: str,
    out: str,
    language: str,
    config: CurationConfig = CurationConfig(),
    make_diarizer: Callable[[], Diarizer] | None = None,
    clean_path: str | None = None,
    export: bool = False,
) -> DataFrame:
    """Curate one language into a ledger and four manifests; returns its kept clips.

    With a clean result for this language at `clean_path` only its manifests are written. Without a
    diarizer every clip passes the speaker test. Running again continues from the ledger. `export` also writes
    the WAV files, and the manifests then name no file that is not there.
    """
    if clean_path and clip_source.clean_exists(spark, clean_path, language):
        clean = clip_source.read_clean(spark, clean_path, language)
        kept = written(clean_manifest(clean), "manifest")
        if export:
            kept = _exported(kept, clean.select("id", "language", "audio"), out, language)
        write_manifests(kept, out, language)
        return kept
    return curate_raw(spark, raw_path, out, language, config, make_diarizer, export).kept


def _exported(kept: DataFrame, audio: DataFrame, out: str, language: str) -> DataFrame:
    """Write WAV files; the rows of `kept` whose file is there. What could not be written goes to `wav_errors`."""
    done = written(export_wavs(audio, out, language), "exported")
    folder = f"{out.rstrip('/')}/{language}"
    done.where(F.col("status") != "written").write.mode("overwrite").parquet(f"{folder}/{ERRORS_FOLDER}")
    return written(pack.with_wav_present(kept, _wavs(kept.sparkSession, out, language)), "exported")


def _wavs(spark: SparkSession, out: str, language: str) -> DataFrame:
    folder = wav_folder(out, language)
    os.makedirs(folder, exist_ok=True)
    return manifests.list_wavs(spark, folder)


def export_language(spark: SparkSession, raw_path: str, out: str, language: str) -> DataFrame:
    """Write the WAV files of kept clips that are not there yet; returns the kept clips that have a file.

    Audio is read for these clips alone and not shuffled, unless their places are too many to be sent to executors.
    """
    ledger = read_ledger(spark, f"{out.rstrip('/')}/{LEDGER_FOLDER}")
    kept = written(pack.manifest(in_languages(ledger, (language,))), "kept")
    todo = kept.join(_wavs(spark, out, language).select("wav_path"), "wav_path", "left_anti")
    todo = written(todo.select(*packing.PLACE), "to-export")
    clips = clip_source.read_raw(spark, raw_path).where(F.col("language") == language)
    audio = packing.at_places(clips.select(*packing.PLACE, "audio"), todo)
    if audio is None:
        audio = clips.join(todo, list(packing.PLACE), "left_semi")
    return _exported(kept, audio, out, language)


def curate_raw(
    spark: SparkSession,
    raw_path: str,
    out: str,
    language: str,
    config: CurationConfig = CurationConfig(),
    make_diarizer: Callable[[], Diarizer] | None = None,
    export: bool = False,
) -> CurationResult:
    """Curate one language; a run that was cut off goes on where it stopped.

    Clips are folded, held against the ledger and tested by their text without their audio. Audio is read for what is
    left, from the files that hold it: once for the headers and once, unit by unit, for the diarizer. With `export`
    it is read once more for files that are not written yet, and clips without a file are not in the result.
    """
    curator = Curator(replace(config, languages=(language,)))
    raw = clip_source.read_raw(spark, raw_path)
    clips = raw.where(F.col("language") == language)
    narrow = clips.select("id", "language", "text", *SOURCE_ORDER)
    ledger_path = f"{out.rstrip('/')}/{LEDGER_FOLDER}"
    measured = written(
        curator.measured(
            narrow, read_ledger(spark, ledger_path), measure=lambda rows: with_headers(rows, clips, curator.config)
        ),
        "measured",
    )
    diarization = None
    if make_diarizer is not None:
        wanted = curator.passing(measured).withColumn("unit", source_unit())
        audio = clips.select("id", "language", "audio", *SOURCE_ORDER)
        progress = f"{out.rstrip('/')}/{PROGRESS_FOLDER}/{language}"
        diarization = written(diarize_in_units(audio, wanted, make_diarizer, progress), "diarization")
    result = curator.run_and_record(narrow, ledger_path, diarization, scanned=raw, measured=measured)
    if export:
        result = replace(result, kept=export_language(spark, raw_path, out, language))
    write_manifests(result.kept, out, language)
    return result


def curate_new_files(
    spark: SparkSession,
    raw_path: str,
    out: str,
    checkpoint: str,
    config: CurationConfig = CurationConfig(),
) -> DataFrame:
    """Curate the files added since the last call, without a diarizer; returns all verdicts so far."""
    ledger_path = f"{out.rstrip('/')}/{LEDGER_FOLDER}"
    query = curate_stream(
        clip_source.stream_raw(spark, raw_path), ledger_path, checkpoint, Curator(config), prepare=clip_index
    )
    query.awaitTermination()
    return read_ledger(spark, ledger_path)


def pack_languages(
    spark: SparkSession, raw_path: str, out: str, languages: tuple[str, ...]
) -> DataFrame:
    """Pack the kept clips of several languages anew; returns and writes their counts."""
    packing.start_over(spark, out)
    return pack_new_clips(spark, raw_path, out, languages)


def pack_new_clips(
    spark: SparkSession, raw_path: str, out: str, languages: tuple[str, ...]
) -> DataFrame:
    """Add kept clips that are in no shard yet; full shards stay as they are. Returns and writes the counts of all.

    Clips whose recording is no longer in the raw folder are left out before shards are numbered, so shards stay
    full, and are written to the `missing` folder. A shard count that differs from what was to be written is an error.
    """
    root = out.rstrip("/")
    kept = written(
        pack.manifest(in_languages(read_ledger(spark, f"{root}/{LEDGER_FOLDER}"), languages)), "kept"
    )
    audio = in_languages(clip_source.read_raw(spark, raw_path), languages)
    place = list(packing.PLACE)
    there = audio.select(*place)
    kept.join(there, place, "left_anti").select(*place).write.mode("overwrite").parquet(f"{root}/{MISSING_FOLDER}")
    packing.append_clips(kept.join(there, place, "left_semi"), audio, out)
    language = [f for f in CLEAN_CLIP.fields if f.name == "language"]
    counts = written(clean_counts(packing.read_shards(spark, out, language).select("language")), "counts")
    tables.write_stats(counts, f"{root}/{STATS_FOLDER}")
    return counts


def generate_speech(
    spark: SparkSession,
    references: str,
    out: str,
    make_synthesizer: Callable[[], Synthesizer],
    texts_file: str | None = None,
    texts: list[str] | None = None,
    settings: tuple = (generation.DEFAULT_PRESET,),
) -> DataFrame:
    """Speak every text with every reference voice; returns the summary of the written log.

    What an earlier run into the same folder has spoken is not spoken again. The summary reads the log, because the
    model must not run a second time.
    """
    voices = manifests.list_references(spark, references).select("ref_name", F.col("path").alias("ref_path"))
    plan = generation.generation_plan(
        manifests.choose_texts(spark, texts_file, texts),
        voices,
        generation.presets(spark, settings),
        *manifests.TEXT_ORDER,
    )
    path = f"{out.rstrip('/')}/{LOG_FOLDER}"
    log = generate_in_units(plan, make_synthesizer, f"{out.rstrip('/')}/{PROGRESS_FOLDER}/generation")
    tables.write_generation_log(log, path)
    return generation.generation_summary(spark.read.schema(log.schema).json(path))
