"""Speech-shaped views of the given tables, once for Spark and once as DuckDB SQL.

A clip is one line of a document, whole. Later deliveries, the ledger and the file listing follow the labels
table; segments are the phrases of a clip; recordings carry the bytes of a conversation turn as samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clipcurate.functions.names import wav_path
from clipcurate.functions.text import WHITESPACE_RANGES, characters
from clipcurate.plans.generate import PRESETS

RATE = 24000
RECORDING_RATE = 200
EPOCH = "timestamp_ntz'2024-01-01 00:00:00'"
PHRASE_END = "[,.;:!?]+ ?"
WHITESPACE = "[{}]+".format(
    "".join(f"\\x{{{low:04X}}}-\\x{{{high:04X}}}" for low, high in WHITESPACE_RANGES)
)

CLIP_COLUMNS = ("id", "language", "text", "frames", "sampling_rate", "src_file", "src_row")


# A scan of at most this many splits is about a gigabyte, so spreading it over all cores is cheap.
SMALL_SCAN = 8


# Schemas and split counts of tables already seen, so that they are looked up once per application.
_schemas: dict[tuple[str, str], StructType] = {}
_splits: dict[tuple[str, str], int] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for row-heavy work. One small file is one row group, which only one task could read."""
    rows = table(spark, sf_dir, name)
    key = (spark.sparkContext.applicationId, f"{sf_dir}/{name}.parquet")
    if key not in _splits:
        _splits[key] = rows.rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    return rows if _splits[key] > min(SMALL_SCAN, cores) else rows.repartition(cores)


def lines_to_clips(documents: DataFrame) -> DataFrame:
    """Clips with `doc_id`; the speaking rate of a line is 3 to 29 characters per second."""
    lines = documents.select(
        "doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("line_no", "text")
    )
    rate = 3 + (F.col("doc_id") * 7 + F.col("line_no") * 13) % 27
    return lines.select(
        "doc_id",
        F.concat_ws("-", "doc_id", "line_no").alias("id"),
        F.col("lang").alias("language"),
        "text",
        F.call_function("div", F.length("text").cast("long") * RATE, rate).alias("frames"),
        F.lit(RATE).alias("sampling_rate"),
        F.col("source").alias("src_file"),
        (F.col("doc_id") * 100000 + F.col("line_no")).alias("src_row"),
    )


def doc_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_to_clips(spread_table(spark, sf_dir, "documents"))


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_clips(spark, sf_dir).select(*CLIP_COLUMNS)


def labelled_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_clips(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")


def delivered_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips of labelled documents came twice, with the other copy in a file that sorts first."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("again"))
    file, frames = F.col("src_file"), F.col("frames")
    first = F.struct(frames.alias("frames"), file.alias("src_file"))
    again = F.struct((frames + 2400).alias("frames"), F.concat(F.lit("re-"), file).alias("src_file"))
    copies = F.when(F.col("again"), F.array(first, again)).otherwise(F.array(first))
    both = doc_clips(spark, sf_dir).join(labels, "doc_id", "left").withColumn("c", F.explode(copies))
    return both.select(
        "id", "language", "text", "c.frames", "sampling_rate", "c.src_file", "src_row"
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_clips(spark, sf_dir).where("quality = 0").select("language", "id")


def wav_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = labelled_clips(spark, sf_dir).where("toxic = 0")
    return present.select(wav_path(F.col("id")).alias("wav_path"))


def _status() -> Column:
    """The status of a clip's diarization. Asked of each of its phrases instead, these would carry the whole text."""
    return F.when(F.contains("text", F.lit("@")), "failed").otherwise("ok").alias("status")


def _phrases(clips_in: DataFrame) -> DataFrame:
    split = F.split("text", PHRASE_END)
    rows = clips_in.select(F.col("id").alias("clip_id"), _status(), split.alias("_phrases"))
    return rows.select("clip_id", "status", F.posexplode("_phrases").alias("pos", "phrase"))


def _segment_columns(phrase: Column, pos: Column) -> list[Column]:
    start = pos.cast("long") * 1_000_000
    return [
        start.alias("start_us"),
        (start + F.length(phrase) * 12_000).alias("end_us"),
        F.when(F.contains(phrase, F.lit("j")), "B").otherwise("A").alias("speaker"),
    ]


def clip_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = _phrases(clips(spark, sf_dir)).where(F.length("phrase") >= 4)
    return phrases.select("clip_id", *_segment_columns(F.col("phrase"), F.col("pos")))


def diarization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments of each clip; a phrase too short to be one leaves a row without bounds."""
    return _phrases(clips(spark, sf_dir)).select(
        "clip_id", *_heard_columns(F.col("phrase"), F.col("pos")), "status"
    )


def _heard_columns(phrase: Column, pos: Column) -> list[Column]:
    heard = F.length(phrase) >= 4
    names = ("start_us", "end_us", "speaker")
    return [F.when(heard, c).alias(n) for n, c in zip(names, _segment_columns(phrase, pos))]


def hearings(clips_in: DataFrame) -> DataFrame:
    """`diarization` with one row per clip: its `segments` as an array, those of all clips of that id."""
    others = [c for c in clips_in.columns if c not in ("id", "text")]
    segments = F.transform(F.split("text", PHRASE_END), lambda phrase, pos: F.struct(*_heard_columns(phrase, pos)))
    rows = clips_in.select("id", segments.alias("_segments"), _status(), F.struct(*others).alias("_clip"))
    heard = rows.groupBy("id").agg(
        F.flatten(F.collect_list("_segments")).alias("segments"),
        F.max("status").alias("status"),
        F.collect_list("_clip").alias("_clips"),
    )
    return heard.select("id", "segments", "status", F.explode("_clips").alias("_clip")).select("id", "segments", "status", "_clip.*")


def event_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longer segment lists: the events of one user and day."""
    start = F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, ts)")
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") * 100 + F.day("ts")).cast("string").alias("clip_id"),
        F.col("event_type").alias("speaker"),
        start.alias("start_us"),
        (start + F.floor(F.col("value") * 100).cast("long") * 1_200_000).alias("end_us"),
    )


def base_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The characters of the benchmark texts with ids by code point."""
    from clipcurate.operators.vocab import distinct_characters, extend_vocab

    empty = spark.createDataFrame([], "token string, token_id int")
    chars = distinct_characters(table(spark, sf_dir, "benchmark"))
    return extend_vocab(empty, chars).select("token", "token_id")


def token_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.transform(characters(F.col("text")), lambda c: F.ascii(c))
    return clips(spark, sf_dir).select("id", "language", tokens.alias("speech_tokens"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.lower("n_name")
    return table(spark, sf_dir, "nation").select(
        name.alias("ref_name"), F.concat(F.lit("voices/"), name, F.lit(".wav")).alias("ref_path")
    )


def _le(value, digits: int = 8):
    """A number as little-endian hex text."""
    h = F.lpad(F.hex(value), digits, "0")
    return F.concat(*[F.substring(h, at, 2) for at in range(digits - 1, 0, -2)])


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 16-bit mono WAV per conversation turn. Assistant turns have a LIST chunk before the samples."""
    turns = table(spark, sf_dir, "conversations")
    note = F.when(F.col("role") == "assistant", F.repeat("text", 4))
    return turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.lit("en").alias("language"),
        wav_audio(RECORDING_RATE, note).alias("audio"),
    )


def wav_audio(rate: int, note: Column) -> Column:
    """The bytes of `text` as 16-bit samples of a mono WAV file, after a LIST chunk where there is a note."""
    size = F.octet_length("text")
    fmt = [
        F.lit("666D7420"), F.lit("10000000"), F.lit("01000100"), _le(F.lit(rate)), _le(F.lit(rate * 2)), F.lit("02001000"),
    ]
    chunk = F.coalesce(
        F.concat(F.unhex(F.concat(F.lit("4C495354"), _le(F.octet_length(note)))), F.encode(note, "UTF-8")),
        F.unhex(F.lit("")),
    )
    riff = 36 + size + F.octet_length(chunk)
    data = F.concat(
        F.unhex(F.concat(F.lit("52494646"), _le(riff), F.lit("57415645"), *fmt)),
        chunk,
        F.unhex(F.concat(F.lit("64617461"), _le(size))),
        F.encode("text", "UTF-8"),
    )
    return F.struct(data.alias("bytes"), F.lit(rate).alias("sampling_rate"))


# Samples per second of the raw folder: a line of a hundred bytes lasts six seconds.
RAW_RATE = 8


def raw_folder(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write every line of every document as a WAV clip, one partition folder per language."""
    lines = doc_clips(spark, sf_dir).select("id", "language", "text")
    audio = wav_audio(RAW_RATE, F.lit(None).cast("string"))
    lines.select("id", audio.alias("audio"), "text", "language").write.partitionBy("language").parquet(path)


# DuckDB counterparts, as common table expressions in order of use.
CTES: dict[str, str] = {
    "doc_clips": f"""
        select doc_id, concat(doc_id, '-', line_no) as id, lang as language, text,
               (len(text) * {RATE}) // (3 + (doc_id * 7 + line_no * 13) % 27) as frames,
               {RATE} as sampling_rate, source as src_file, doc_id * 100000 + line_no as src_row
        from (select doc_id, lang, source, unnest(string_split(text, chr(10))) as text,
                     unnest(range(0, len(string_split(text, chr(10))))) as line_no
              from documents)""",
    "clips": """
        select id, language, text, frames, sampling_rate, src_file, src_row from doc_clips""",
    "labelled": """
        select c.*, quality, toxic from doc_clips c join labels using (doc_id)""",
    "delivered": """
        select * from clips union all
        select id, language, text, frames + 2400, sampling_rate, concat('re-', src_file), src_row
        from labelled""",
    "ledger": "select language, id from labelled where quality = 0",
    "wav_listing": "select concat('wavs/', id, '.wav') as wav_path from labelled where toxic = 0",
    "clip_segments": f"""
        select clip_id, pos * 1000000 as start_us, pos * 1000000 + len(phrase) * 12000 as end_us,
               case when contains(phrase, 'j') then 'B' else 'A' end as speaker
        from (select id as clip_id, unnest(string_split_regex(text, '{PHRASE_END}')) as phrase,
                     unnest(range(0, len(string_split_regex(text, '{PHRASE_END}')))) as pos
              from clips)
        where len(phrase) >= 4""",
    "diar_status": """
        select id as clip_id, case when contains(text, '@') then 'failed' else 'ok' end as status
        from clips""",
    "event_segments": """
        select cast(user_id * 100 + day(ts) as varchar) as clip_id, event_type as speaker,
               epoch_us(ts) - 1704067200000000 as start_us,
               epoch_us(ts) - 1704067200000000 + cast(floor(value * 100) as bigint) * 1200000 as end_us
        from events""",
    "speakers": """
        select clip_id, n <= 1 and not has_overlap and not failed as single_speaker
        from (select s.clip_id, s.failed, coalesce(n, 0) as n, coalesce(o, false) as has_overlap
              from (select clip_id, bool_or(status <> 'ok') as failed from diar_status group by 1) s
              left join (select clip_id, count(distinct speaker) as n, bool_or(start_us < m) as o
                         from (select *, max(end_us) over (partition by clip_id order by start_us, end_us
                                   rows between unbounded preceding and 1 preceding) as m
                               from clip_segments)
                         group by 1) g on g.clip_id = s.clip_id)""",
    "firsts": """
        select * from (select *, count(*) over (partition by language, id) as copies,
                              row_number() over (partition by language, id order by src_file, src_row) as rn
                       from delivered)
        where rn = 1""",
    "measured": f"""
        select *, case when duration <= 0 then 0.0 else len(clean_text) / duration end as cps
        from (select *, cast(frames as double) / cast(sampling_rate as double) as duration,
                     (2000 * frames + sampling_rate) // (2 * sampling_rate) as duration_ms,
                     trim(regexp_replace(replace(replace(text, '>', ''), '|', ' '),
                                         '{WHITESPACE}', ' ', 'g')) as clean_text
              from clips)""",
    "measured_firsts": f"""
        select *, case when duration <= 0 then 0.0 else len(clean_text) / duration end as cps
        from (select *, cast(frames as double) / cast(sampling_rate as double) as duration,
                     (2000 * frames + sampling_rate) // (2 * sampling_rate) as duration_ms,
                     trim(regexp_replace(replace(replace(text, '>', ''), '|', ' '),
                                         '{WHITESPACE}', ' ', 'g')) as clean_text
              from firsts)""",
    "verdicts": """
        select f.*, case when len(clean_text) < 2 then 'text_rejected'
                         when duration is null then 'decode_error'
                         when not duration between 2.0 and 20.0 then 'duration_rejected'
                         when not cps between 4.0 and 25.0 then 'cps_rejected'
                         when not coalesce(single_speaker, true) then 'multi_speaker_rejected'
                         else 'kept' end as verdict
        from measured_firsts f left join speakers s on s.clip_id = f.id""",
    "kept": """
        select id, language, concat('wavs/', id, '.wav') as wav_path, clean_text as text,
               concat('spk_hf_', language) as speaker, duration, duration_ms, cps, src_file, src_row
        from verdicts where verdict = 'kept'""",
    "base_vocab": """
        select token, cast(row_number() over (order by unicode(token)) - 1 as int) as token_id
        from (select distinct unnest(string_split(text, '')) as token from benchmark)
        where token <> ''""",
    "corpus_chars": """
        select token, count(*) as n
        from (select unnest(string_split(text, '')) as token from documents) group by 1""",
    "token_samples": """
        select id, language, [unicode(c) for c in string_split(text, '')] as speech_tokens from clips""",
    "texts": """
        select row_number() over (order by conv_id, turn) as sample_no, text from conversations""",
    "refs": """
        select lower(n_name) as ref_name, concat('voices/', lower(n_name), '.wav') as ref_path
        from nation""",
    "presets": "select * from (values {}) as t(preset, exaggeration, cfg_weight)".format(
        ", ".join(f"('{p}', cast({e} as double), cast({c} as double))" for p, e, c in PRESETS)
    ),
    "plan": """
        select ref_name, ref_path, preset, exaggeration, cfg_weight, sample_no, text,
               concat(ref_name, '_sample_',
                      case when sample_no < 1000 then lpad(cast(sample_no as varchar), 3, '0')
                           else cast(sample_no as varchar) end, '.wav') as file
        from texts, refs, presets""",
    "recordings": """
        select concat(conv_id, '-', turn) as id, strlen(text) as n_bytes,
               44 + strlen(text) + case when role = 'assistant' then 8 + 4 * strlen(text) else 0 end as size
        from conversations""",
}

_USES = {
    "clips": ("doc_clips",),
    "labelled": ("doc_clips",),
    "delivered": ("clips", "labelled"),
    "ledger": ("labelled",),
    "wav_listing": ("labelled",),
    "clip_segments": ("clips",),
    "diar_status": ("clips",),
    "speakers": ("clip_segments", "diar_status"),
    "firsts": ("delivered",),
    "measured": ("clips",),
    "measured_firsts": ("firsts",),
    "verdicts": ("measured_firsts", "speakers"),
    "kept": ("verdicts",),
    "token_samples": ("clips",),
    "plan": ("texts", "refs", "presets"),
}


def sql(body: str, *ctes: str) -> str:
    """`body` with the views it names, and the views those need, in front."""
    needed: set[str] = set()
    todo = list(ctes)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo.extend(_USES.get(name, ()))
    views = [f"{name} as ({CTES[name]})" for name in CTES if name in needed]
    return (f"with {', '.join(views)} " if views else "") + body
