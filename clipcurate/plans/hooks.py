"""Places where a user's model runs inside a Spark stage.

Each takes a factory: the model is built once per task, before its first batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipcurate.plans.progress import WAVE_UNITS, run_in_units
from clipcurate.schemas import DIARIZATION, GENERATION_LOG
from clipcurate.session import written

# (audio bytes, sampling rate) -> (start seconds, end seconds, speaker) per segment
Diarizer = Callable[[bytes, int], Iterable[tuple[float, float, str]]]
# (text, reference path, exaggeration, cfg weight, file name) -> (frames, rate)
Synthesizer = Callable[[str, str, float, float, str], tuple[int, int]]

# The status of a clip, or of a text to speak, whose model took its worker down.
CRASHED = "error: crashed"

#: Sample numbers of a unit of generation.
UNIT_SAMPLES = 500

_DIARIZATION_COLUMNS = DIARIZATION.fieldNames()
_LOG_COLUMNS = GENERATION_LOG.fieldNames()


def _segments_of(diarizer: Diarizer, clip_id: str, data: bytes, rate: int) -> list[tuple]:
    try:
        found = [
            (clip_id, round(start * 1_000_000), round(end * 1_000_000), str(speaker), "ok")
            for start, end, speaker in diarizer(data, rate)
        ]
        return found or [(clip_id, None, None, None, "ok")]
    except Exception as e:
        return [(clip_id, None, None, None, f"error: {e}")]


def diarize(clips: DataFrame, make_diarizer: Callable[[], Diarizer]) -> DataFrame:
    """Diarization rows of clips `(id, audio)`, with their `language` if they have one.

    A failing clip is recorded and the rest go on. The result is written once, because a model must not run again for
    every use of its output.
    """
    return written(_diarized(clips, make_diarizer), "diarization")


def diarize_in_units(
    clips: DataFrame,
    wanted: DataFrame,
    make_diarizer: Callable[[], Diarizer],
    folder: str,
    wave_units: int = WAVE_UNITS,
    most_waves: int | None = None,
) -> DataFrame:
    """`diarize` of the `wanted` clips `(language, id, unit)`, finished unit by unit in a folder of progress.

    A clip of which the folder has rows is not heard again, whatever became of the run that heard it. A clip that kills
    its worker is recorded as `error: crashed`. `clips` has the audio, and `src_file` if it names the source files: only
    the files of a wave are then read for it. Rows of clips that are no longer wanted stay in the result.
    """
    place = [c for c in ("src_file", "src_row") if c in clips.columns and c in wanted.columns]
    schema = _diarized(clips.limit(0), make_diarizer).schema

    def work(keys: DataFrame) -> DataFrame:
        audio = clips
        if place:
            audio = clips.where(F.col("src_file").isin(*[r[0] for r in keys.select("src_file").distinct().collect()]))
        return _diarized(audio.join(keys.select("language", "id", *place), ["language", "id", *place], "left_semi"), make_diarizer)

    def give_up(keys: DataFrame) -> DataFrame:
        values = {"clip_id": F.col("id"), "language": F.col("language"), "status": F.lit(CRASHED)}
        return keys.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])

    key = {"language": "language", "id": "clip_id"}
    return run_in_units(wanted, work, give_up, folder, schema, key, wave_units, most_waves)


def _diarized(clips: DataFrame, make_diarizer: Callable[[], Diarizer]) -> DataFrame:
    with_language = "language" in clips.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        diarizer = make_diarizer()
        for batch in batches:
            rows, languages = [], []
            for i, (clip_id, data, rate) in enumerate(zip(batch["id"], batch["bytes"], batch["rate"])):
                found = _segments_of(diarizer, clip_id, data, rate)
                rows.extend(found)
                languages.extend([batch["language"].iloc[i] if with_language else None] * len(found))
            out = pd.DataFrame(rows, columns=_DIARIZATION_COLUMNS)
            if with_language:
                out["language"] = languages
            yield out.astype({"start_us": "Int64", "end_us": "Int64"})

    inputs = clips.select(
        "id",
        F.col("audio.bytes").alias("bytes"),
        F.col("audio.sampling_rate").alias("rate"),
        *(["language"] if with_language else []),
    )
    schema = T.StructType([*DIARIZATION.fields, *[f for f in inputs.schema.fields if f.name == "language"]])
    return inputs.mapInPandas(run, schema)


def _generate_one(synthesizer: Synthesizer, row) -> tuple:
    file = row.file
    try:
        frames, rate = synthesizer(
            row.text, row.ref_path, row.exaggeration, row.cfg_weight, file
        )
        result = (file, round(frames / rate, 2), "ok")
    except Exception as e:
        result = (None, 0.0, f"error: {e}")
    return (row.ref_name, row.preset, row.sample_no, row.text, *result)


def generate(
    plan: DataFrame, make_synthesizer: Callable[[], Synthesizer], tasks: int | None = None
) -> DataFrame:
    """One log row per plan row; a failing row is recorded and the rest go on.

    The plan is spread over `tasks` tasks by its key first (four per core if not given), as few texts would otherwise
    mean few tasks for a slow model. Adaptive execution does not merge a given number of partitions.
    """
    tasks = tasks or 4 * plan.sparkSession.sparkContext.defaultParallelism

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        synthesizer = make_synthesizer()
        for batch in batches:
            rows = [_generate_one(synthesizer, row) for row in batch.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=_LOG_COLUMNS)

    spread = plan.repartition(tasks, "ref_name", "preset", "sample_no").select(
        "ref_name", "ref_path", "preset", "exaggeration", "cfg_weight", "sample_no", "text", "file"
    )
    return spread.mapInPandas(run, GENERATION_LOG)


_SPOKEN = ("ref_name", "preset", "sample_no", "text_hash")


def generate_in_units(
    plan: DataFrame,
    make_synthesizer: Callable[[], Synthesizer],
    folder: str,
    unit_samples: int = UNIT_SAMPLES,
    wave_units: int = WAVE_UNITS,
    most_waves: int | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """`generate` of a plan, finished unit by unit in a folder of progress.

    A unit is a stretch of `unit_samples` sample numbers of a voice and preset. What a committed unit has spoken is not
    spoken again, unless its text is another one now. A text that kills its worker is recorded as `error: crashed`, and
    the others of its unit are spoken. The result has the rows of this plan only, whatever else the folder holds; rows
    that are repeated in the plan are spoken once.
    """
    block = F.call_function("div", F.col("sample_no"), F.lit(unit_samples).cast("long")).cast("string")
    hashed = plan.withColumn("text_hash", F.xxhash64("text"))
    # The keys are narrow: a plan repeats each text for every voice, so its texts are only made wave by wave.
    # Units are in order of their samples, so that a wave needs a stretch of the texts for all voices.
    unit = F.concat_ws("#", F.lpad(block, 12, "0"), "ref_name", "preset")
    keys = hashed.select(*_SPOKEN).distinct().withColumn("unit", unit)
    schema = T.StructType([*GENERATION_LOG.fields, T.StructField("text_hash", T.LongType())])

    def planned(part: DataFrame) -> DataFrame:
        low, high = part.agg(F.min("sample_no"), F.max("sample_no")).first()
        stretch = hashed.where(F.col("sample_no").between(low, high))
        return stretch.join(part.select(*_SPOKEN), list(_SPOKEN), "left_semi").dropDuplicates(_SPOKEN)

    def work(part: DataFrame) -> DataFrame:
        return generate(planned(part), make_synthesizer, tasks).withColumn("text_hash", F.xxhash64("text"))

    def give_up(part: DataFrame) -> DataFrame:
        values = {"file": F.lit(None), "duration": F.lit(0.0), "status": F.lit(CRASHED)}
        return planned(part).select(*[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])

    spoken = run_in_units(keys, work, give_up, folder, schema, {c: c for c in _SPOKEN}, wave_units, most_waves)
    wanted = hashed.select(*_SPOKEN)
    # Only the keys are compared; the texts of the log are not shuffled unless it has rows of another plan.
    if not spoken.select(*_SPOKEN).join(wanted, list(_SPOKEN), "left_anti").isEmpty():
        spoken = spoken.join(wanted, list(_SPOKEN), "left_semi")
    return spoken.select(*_LOG_COLUMNS)
