"""Queries that write files in the shared folder and read them back, and manifest lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipcurate.functions.names import CSV_HEADER, csv_line, wav_path
from clipcurate.operators import pack
from clipcurate.plans import jobs, packing
from clipcurate.schemas import CLEAN_CLIP
from clipcurate.session import scratch_path
from clipcurate.sinks import tables, text, vocabulary, wav
from clipcurate.sources import clips as clip_source
from clipcurate.sources import ledger, manifests
from clipcurate.sources.vocabulary import read_vocabulary_lines
from clipcurate.sources.wav import with_wav_info
from queries import curation, generation, views

ROOT = "/data/clips"


def manifest_csv(spark, d):
    return text.csv_lines(curation.kept(spark, d))


def wav_scp(spark, d):
    return text.wav_scp_lines(curation.kept(spark, d), ROOT)


def utt_text(spark, d):
    return text.text_lines(curation.kept(spark, d))


def utt2spk(spark, d):
    return text.speaker_lines(curation.kept(spark, d))


def manifest_pipe(spark, d):
    return text.pipe_lines(curation.kept(spark, d))


def manifest_convert(spark, d):
    """Write the CSV manifest, read it back and turn it into pipe lines."""
    path = scratch_path(spark, "manifest")
    text.write_lines(text.csv_lines(curation.kept(spark, d)), path, CSV_HEADER)
    return text.csv_to_pipe(manifests.read_csv_manifest(spark, path))


def manifest_split(spark, d):
    """Whole documents, line breaks and all, as texts of a CSV manifest that is read in splits."""
    docs = views.table(spark, d, "documents").select(F.format_string("%012d", "doc_id").alias("id"), "text")
    quoted = csv_line(wav_path(F.col("id")), F.coalesce("text", F.lit("")), F.octet_length("id").cast("long"))
    path = scratch_path(spark, "manifest")
    text.write_lines(docs.select("id", quoted.alias("line")), path, CSV_HEADER)
    return manifests.read_csv_manifest(spark, path, split=True)


def manifest_read(spark, d):
    """Pipe lines of every clip, with its text as it came, read back by their fields."""
    rows = views.clips(spark, d).select("id", wav_path(F.col("id")).alias("wav_path"), "text", "language")
    path = scratch_path(spark, "pipe")
    text.write_lines(text.pipe_lines(rows), path)
    return manifests.read_pipe_manifest(spark, path)


def text_list(spark, d):
    """Documents as text files, padded with white space; every line comes back stripped."""
    path = scratch_path(spark, "texts")
    padded = F.concat(F.lit("\t "), F.col("text"), F.lit("　\n\n"))
    views.table(spark, d, "documents").select(padded.alias("value")).write.text(path)
    texts = manifests.choose_texts(spark, path)
    return texts.groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def wav_info(spark, d):
    info = with_wav_info(views.recordings(spark, d))
    return info.select(
        "id", "frames", "header_rate", "channels", "sample_bits", "decode_error"
    )


def _exported(spark, d):
    root = scratch_path(spark, "wavs")
    return root, wav.export_wavs(views.recordings(spark, d), root, "en")


def wav_export(spark, d):
    return _exported(spark, d)[1].select("id", "n_bytes", "status")


def reference_listing(spark, d):
    root, done = _exported(spark, d)
    done.write.format("noop").mode("overwrite").save()
    listed = manifests.list_references(spark, f"{root}/en/wavs")
    return listed.select("name", "ref_name", "length")


def wav_listing(spark, d):
    root, done = _exported(spark, d)
    done.write.format("noop").mode("overwrite").save()
    return manifests.list_wavs(spark, f"{root}/en/wavs")


def shards(spark, d):
    rows = pack.assign_shards(curation.kept_table(spark, d).select("language", "id"))
    return rows.select("language", "id", "shard_id")


def shard_sizes(spark, d):
    rows = pack.assign_shards(curation.kept_table(spark, d).select("language", "id"))
    return rows.groupBy("shard_id").agg(F.count(F.lit(1)).alias("clips"))


def _packed(spark, d):
    clips = views.delivered_clips(spark, d)
    audio = clips.select(
        "src_file",
        "src_row",
        F.struct(F.encode("text", "UTF-8").alias("bytes"), F.col("sampling_rate")).alias("audio"),
    )
    sharded = pack.assign_shards(curation.kept_table(spark, d))
    return tables.write_shards(
        tables.packed_rows(sharded, audio), scratch_path(spark, "packed")
    )


def pack_append(spark, d):
    """Clips of the ledger are packed first, all others are added to their shards by a second call."""
    clips, out = views.delivered_clips(spark, d), scratch_path(spark, "packed")
    audio = clips.select(
        *packing.PLACE, F.struct(F.encode("text", "UTF-8").alias("bytes"), F.col("sampling_rate")).alias("audio")
    )
    kept = curation.kept_table(spark, d)
    packing.append_clips(kept.join(views.ledger(spark, d), ["language", "id"], "left_semi"), audio, out)
    packing.append_clips(kept, audio, out)
    return _packed_columns(packing.read_shards(spark, out, CLEAN_CLIP.fields))


def packed(spark, d):
    """Kept clips as written shards, with the audio of the copy that was kept."""
    return _packed_columns(spark.read.parquet(_packed(spark, d)))


def _packed_columns(rows):
    return rows.select(
        "shard",
        "id",
        "language",
        "text",
        "speaker_id",
        F.octet_length("audio.bytes").alias("n_bytes"),
        F.col("audio.sampling_rate").alias("sampling_rate"),
        F.round(F.col("duration_sec") * 1000).cast("long").alias("duration_ms"),
    )


def pack_partitioned(spark, d):
    """Whole jobs: a raw folder with one partition folder per language is curated language by language and packed."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "out")
    views.raw_folder(spark, d, raw)
    languages = sorted(r[0] for r in views.table(spark, d, "documents").select("lang").distinct().collect())
    for language in languages:
        jobs.curate_raw(spark, raw, out, language)
    jobs.pack_languages(spark, raw, out, tuple(languages))
    rows = spark.read.parquet(f"{out}/{tables.SHARD_FOLDER}")
    samples = F.expr("substring(audio.bytes, 45)")
    return rows.select("shard", "id", "language", "text", F.md5(samples).alias("audio_md5"))


def clean_scan(spark, d):
    """The packed clips of one language, found and scanned as an existing clean result."""
    path = _packed(spark, d)
    if not clip_source.clean_exists(spark, path, "en"):
        raise ValueError("no packed clips were found")
    return clip_source.read_clean(spark, path, "en").select("id", "language", "text", "speaker_id")


def ledger_documents(spark, d):
    """One ledger document per source document, imported as ledger rows."""
    path = scratch_path(spark, "documents")
    docs = views.table(spark, d, "documents")
    ids = F.transform(
        F.split("text", "\n"), lambda _, i: F.concat_ws("-", F.col("doc_id").cast("string"), i.cast("string"))
    )
    entries = F.transform(
        ids,
        lambda i: F.struct(
            wav_path(i).alias("wav_path"), F.col("source").alias("text"), F.lit("spk").alias("speaker"),
            F.lit(2.5).alias("duration"), F.lit(7.25).alias("cps"),
        ),
    )
    # Lines of an even length were kept; the others were processed only.
    even = F.zip_with(F.split("text", "\n"), entries, lambda line, entry: F.when(F.length(line) % 2 == 0, entry))
    kept = F.filter(even, lambda entry: entry.isNotNull())
    document = docs.select(ids.alias("processed_ids"), kept.alias("metadata"))
    document.write.json(path)
    rows = ledger.read_ledger_documents(spark, path, "en", one_per_line=True)
    return rows.select("id", "language", "verdict", "clean_text", "duration", "cps")


def vocab_document(spark, d):
    path = scratch_path(spark, "vocabulary")
    vocabulary.write_vocabulary(views.base_vocab(spark, d), path)
    return read_vocabulary_lines(spark, path)


def generation_log(spark, d):
    path = scratch_path(spark, "log")
    tables.write_generation_log(generation.gen_log(spark, d), path)
    schema = "text string, file string, duration double, status string, ref_name string"
    return spark.read.schema(schema).json(path)


def pack_stats(spark, d):
    path = scratch_path(spark, "stats")
    tables.write_stats(curation.clean_counts(spark, d), path)
    return spark.read.schema("language string, clips long").json(path)


QUERIES = {
    "q_manifest_csv": manifest_csv,
    "q_wav_scp": wav_scp,
    "q_utt_text": utt_text,
    "q_utt2spk": utt2spk,
    "q_manifest_pipe": manifest_pipe,
    "q_manifest_convert": manifest_convert,
    "q_manifest_read": manifest_read,
    "q_manifest_split": manifest_split,
    "q_text_list": text_list,
    "q_wav_meta": wav_info,
    "q_wav_export": wav_export,
    "q_reference_listing": reference_listing,
    "q_wav_listing": wav_listing,
    "q_shards": shards,
    "q_shard_sizes": shard_sizes,
    "q_pack": packed,
    "q_pack_append": pack_append,
    "q_pack_partitioned": pack_partitioned,
    "q_clean_scan": clean_scan,
    "q_ledger_documents": ledger_documents,
    "q_vocab_document": vocab_document,
    "q_generation_log": generation_log,
    "q_pack_stats": pack_stats,
}

_SECONDS = """concat(duration_ms // 1000, '.',
    regexp_replace(lpad(cast(duration_ms % 1000 as varchar), 3, '0'), '0{1,2}$', ''))"""
_SHARD = "(row_number() over (order by language, id) - 1) // 300"
_STRIPPED = """trim(text, '"')"""

ORACLE = {
    "q_manifest_csv": views.sql(
        f"""select id, language, concat(wav_path, ',"', replace(text, '"', '""'), '",', {_SECONDS}) as line
            from kept""",
        "kept",
    ),
    "q_wav_scp": views.sql(
        f"select id, language, concat(id, ' {ROOT}/', language, '/', wav_path) as line from kept", "kept"
    ),
    "q_utt_text": views.sql("select id, language, concat(id, ' ', text) as line from kept", "kept"),
    "q_utt2spk": views.sql("select id, language, concat(id, ' ', speaker) as line from kept", "kept"),
    "q_manifest_pipe": views.sql(
        f"select id, language, concat_ws('|', wav_path, {_STRIPPED}, {_STRIPPED}) as line from kept",
        "kept",
    ),
    "q_manifest_convert": views.sql(
        f"""select wav_path as id, concat_ws('|', wav_path, {_STRIPPED}, {_STRIPPED}) as line
            from kept""",
        "kept",
    ),
    "q_manifest_read": views.sql(
        f"""select parts[1] as wav_path, parts[2] as raw, parts[3] as normalized
            from (select string_split(trim(concat_ws('|', concat('wavs/', id, '.wav'), {_STRIPPED}, {_STRIPPED})), '|')
                         as parts
                  from clips)""",
        "clips",
    ),
    "q_manifest_split": """select concat('wavs/', lpad(cast(doc_id as varchar), 12, '0'), '.wav') as file_name,
            coalesce(text, '') as transcription, cast(0.012 as double) as duration_seconds
        from documents""",
    "q_text_list": """select text, count(*) as n
        from (select trim(unnest(string_split(text, chr(10)))) as text from documents)
        where text <> '' group by 1""",
    "q_wav_meta": views.sql(
        f"""select id, n_bytes // 2 as frames, {views.RECORDING_RATE} as header_rate, 1 as channels,
                   16 as sample_bits, cast(null as varchar) as decode_error
            from recordings""",
        "recordings",
    ),
    "q_wav_export": views.sql(
        "select id, size as n_bytes, 'written' as status from recordings", "recordings"
    ),
    "q_reference_listing": views.sql(
        "select concat(id, '.wav') as name, id as ref_name, size as length from recordings", "recordings"
    ),
    "q_wav_listing": views.sql(
        "select concat('wavs/', id, '.wav') as wav_path, size as length from recordings", "recordings"
    ),
    "q_shards": views.sql(f"select language, id, {_SHARD} as shard_id from kept", "kept"),
    "q_shard_sizes": views.sql(
        f"select shard_id, count(*) as clips from (select {_SHARD} as shard_id from kept) group by 1",
        "kept",
    ),
    "q_pack": views.sql(
        f"""select concat('shard_', lpad(cast(s as varchar), 5, '0')) as shard, id, language, text,
                   speaker as speaker_id, cast(strlen(raw) as int) as n_bytes, 24000 as sampling_rate, duration_ms
            from (select k.*, d.text as raw, (row_number() over (order by k.language, k.id) - 1) // 300 as s
                  from kept k join delivered d using (src_file, src_row))""",
        "kept",
        "delivered",
    ),
    "q_pack_append": views.sql(
        f"""select concat('shard_', lpad(cast(s as varchar), 5, '0')) as shard, id, language, text,
                   speaker as speaker_id, cast(strlen(raw) as int) as n_bytes, 24000 as sampling_rate, duration_ms
            from (select k.*, d.text as raw,
                         (row_number() over (order by l.id is null, k.language, k.id) - 1) // 300 as s
                  from kept k join delivered d using (src_file, src_row)
                  left join (select distinct language, id from ledger) l on l.language = k.language and l.id = k.id)""",
        "kept",
        "delivered",
        "ledger",
    ),
    "q_pack_partitioned": views.sql(
        f"""select concat('shard_', lpad(cast(s as varchar), 5, '0')) as shard, id, language, clean_text as text, audio_md5
            from (select *, (row_number() over (order by language, id) - 1) // 300 as s
                  from (select id, language, md5(text) as audio_md5, {curation._sql_clean('text')} as clean_text,
                               cast(strlen(text) // 2 as double) / {views.RAW_RATE} as seconds
                        from clips)
                  where len(clean_text) >= 2 and seconds between 2.0 and 20.0
                    and len(clean_text) / seconds between 4.0 and 25.0)""",
        "clips",
    ),
    "q_clean_scan": views.sql(
        "select id, language, text, speaker as speaker_id from kept where language = 'en'", "kept"
    ),
    "q_ledger_documents": """
        select id, 'en' as language, case when even then 'kept' end as verdict,
               case when even then source end as clean_text,
               case when even then cast(2.5 as double) end as duration,
               case when even then cast(7.25 as double) end as cps
        from (select concat(doc_id, '-', n) as id, source, len(lines[n + 1]) % 2 = 0 as even
              from (select doc_id, source, lines, unnest(range(0, len(lines))) as n
                    from (select doc_id, source, string_split(text, chr(10)) as lines from documents)))""",
    "q_vocab_document": views.sql("select token, token_id from base_vocab", "base_vocab"),
    "q_generation_log": views.sql(
        f"select text, file, duration, status, ref_name from {generation._LOG}", "plan"
    ),
    "q_pack_stats": curation.ORACLE["q_clean_counts"],
}
