"""Vocabulary, training-sample and vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipcurate.functions import arrays, text
from clipcurate.operators import batches, samples, tokens, vectors, vocab
from clipcurate.operators.batches import BAND_WIDTH
from clipcurate.operators.ordering import number_rows
from clipcurate.plans.vocabulary import grow_vocabulary
from queries import views

# The corpus is in Latin script, so its accented letters stand in for the script to add.
SCRIPT = (0x00C0, 0x00FF)
PROMPT_LEN = 75
STOP_ID = 0
UNKNOWN_ID = -1
MAX_TEXT = 256
MAX_SPEECH = 850
EPOCH = 3
WORD_IDS = 100_000
BATCH_TOKENS = 2_000


def _documents(spark, d):
    return views.spread_table(spark, d, "documents")


def char_inventory(spark, d):
    return vocab.character_counts(_documents(spark, d))


def distinct_chars(spark, d):
    return vocab.distinct_characters(_documents(spark, d))


def script_chars(spark, d):
    return vocab.distinct_characters(_documents(spark, d), script=SCRIPT)


def vocab_new(spark, d):
    chars = vocab.distinct_characters(views.spread_table(spark, d, "pages"), "html")
    return vocab.new_characters(chars, views.base_vocab(spark, d))


def vocab_extend(spark, d):
    pages = views.spread_table(spark, d, "pages")
    return grow_vocabulary(pages, views.base_vocab(spark, d), "html", script=None)


def vocab_stats(spark, d):
    return vocab.vocab_stats(vocab_extend(spark, d))


def char_encode(spark, d):
    table = vocab.char_id_table(views.base_vocab(spark, d), UNKNOWN_ID)
    ids = vocab.encode_characters(F.col("text"), table, UNKNOWN_ID)
    return views.clips(spark, d).select("id", F.array_join(ids, ",").alias("token_ids"))


def _word_vocab(spark, d):
    """The characters of the benchmark and, from WORD_IDS on, its words of several characters."""
    words = views.table(spark, d, "benchmark").select(F.explode(F.split("text", " ")).alias("token"))
    words = number_rows(words.where(F.length("token") > 1).distinct(), "token", name="n")
    ids = (F.col("n") + WORD_IDS).cast("int").alias("token_id")
    return views.base_vocab(spark, d).unionByName(words.select("token", ids))


def token_encode(spark, d):
    rows = tokens.encode_tokens(views.clips(spark, d), _word_vocab(spark, d), UNKNOWN_ID, clusters=False)
    return rows.select("id", F.array_join("token_ids", ",").alias("token_ids"))


def _lengths(spark, d):
    length = F.size("text_tokens") + F.size("speech_tokens")
    kept = samples.limit_lengths(_with_text_tokens(spark, d), MAX_TEXT, MAX_SPEECH)
    return kept.select("id", length.alias("length"))


def batch_plan(spark, d):
    return batches.batch_plan(_lengths(spark, d), BATCH_TOKENS)


def batch_summary(spark, d):
    return batches.batch_summary(batch_plan(spark, d))


def _joined(name):
    return F.array_join(name, ",").alias(name)


def _laid_out(spark, d):
    return samples.layout(views.token_samples(spark, d), PROMPT_LEN, STOP_ID)


def prompt_slice(spark, d):
    return _laid_out(spark, d).select("id", _joined("prompt_tokens"))


def label_mask(spark, d):
    return _laid_out(spark, d).select("id", _joined("labels"))


def append_stop(spark, d):
    return _laid_out(spark, d).select("id", _joined("target_tokens"))


def cond_dropout(spark, d):
    emb = F.array(*[(F.length("id") * i).cast("float") for i in (1, 2, 3)])
    rows = _laid_out(spark, d).withColumn("speaker_emb", emb)
    total = F.aggregate("speaker_emb", F.lit(0.0), lambda a, x: a + x)
    return samples.drop_conditioning(rows, EPOCH).select(
        "id", "cond_dropped", _joined("prompt_tokens"), total.alias("emb_sum")
    )


def _with_text_tokens(spark, d):
    rows = views.token_samples(spark, d)
    words = F.transform(F.array_compact(F.col("speech_tokens")), lambda t: t % 7)
    return rows.withColumn("text_tokens", words)


def length_limits(spark, d):
    kept = samples.limit_lengths(_with_text_tokens(spark, d), MAX_TEXT, MAX_SPEECH)
    return kept.select("id", F.size("text_tokens").alias("text_len"))


def length_cut(spark, d):
    cut = samples.limit_lengths(_with_text_tokens(spark, d), MAX_TEXT, MAX_SPEECH, cut=True)
    return cut.select(
        "id", F.size("text_tokens").alias("text_len"), F.size("speech_tokens").alias("speech_len")
    )


def over_limit(spark, d):
    return samples.over_limit_counts(_with_text_tokens(spark, d), MAX_TEXT, MAX_SPEECH)


def _rounded(rows, column):
    return rows.withColumn(column, F.round(column, 9))


def mean_vector(spark, d):
    table = views.spread_table(spark, d, "embeddings")
    return _rounded(vectors.mean_elements(table, vec="embedding"), "mean")


def group_mean_vector(spark, d):
    table = views.spread_table(spark, d, "embeddings")
    return _rounded(vectors.mean_elements(table, "label", vec="embedding"), "mean")


def vocab_vectors(spark, d):
    """The vector table, grown by one mean row per character that the vocabulary gains."""
    known = views.spread_table(spark, d, "embeddings").select(
        F.col("vec_id").alias("token_id"), F.col("embedding").alias("vec")
    )
    added = vocab_extend(spark, d).where("added").select(
        (F.col("token_id") + 1_000_000).cast("long").alias("token_id")
    )
    grown = vectors.extend_vectors(known, added)
    return _rounded(grown.select("token_id", "added", F.posexplode("vec").alias("pos", "value")), "value")


QUERIES = {
    "q_char_inventory": char_inventory,
    "q_distinct_chars": distinct_chars,
    "q_script_chars": script_chars,
    "q_vocab_new": vocab_new,
    "q_vocab_extend": vocab_extend,
    "q_vocab_stats": vocab_stats,
    "q_char_encode": char_encode,
    "q_token_encode": token_encode,
    "q_batch_plan": batch_plan,
    "q_batch_summary": batch_summary,
    "q_prompt_slice": prompt_slice,
    "q_label_mask": label_mask,
    "q_append_stop": append_stop,
    "q_cond_dropout": cond_dropout,
    "q_length_limits": length_limits,
    "q_length_cut": length_cut,
    "q_over_limit": over_limit,
    "q_mean_vector": mean_vector,
    "q_group_mean_vector": group_mean_vector,
    "q_vocab_vectors": vocab_vectors,
}

_EXTENDED = """(
    select token, token_id, false as added from base_vocab
    union all
    select token, cast((select max(token_id) from base_vocab)
                       + row_number() over (order by unicode(token)) as int), true
    from (select distinct unnest(string_split(html, '')) as token from pages)
    where token <> '' and token not in (select token from base_vocab))"""
_ELEMENTS = """(select vec_id, label, unnest(embedding) as x,
                       cast(unnest(range(0, len(embedding))) as int) as pos
                from embeddings)"""
_MEAN = "round(avg(cast(x as double)), 9)"
_DROPPED = f"""cast(concat('0x', substring(md5(concat(id, '#', '{EPOCH}')), 1, 8)) as bigint) % 100 < 20"""

# No token but the space has a space in it, so distinct words are walked through, from longest token to longest token.
_ENCODED = f"""select * from (
    with recursive word_vocab as (
        select token, token_id from base_vocab
        union all
        select token, cast({WORD_IDS} + row_number() over (order by token) as int)
        from (select distinct unnest(string_split(text, ' ')) as token from benchmark) where len(token) > 1),
    words as (select distinct unnest(string_split(text, ' ')) as word from clips),
    places as (select word, unnest(range(1, len(word) + 1)) as pos from words),
    pieces as (select word, pos, substring(word, pos, size) as token
               from (select word, pos, unnest(range(1, len(word) - pos + 2)) as size from places)),
    best as (select word, pos, max_by(token_id, len(token)) as token_id, max(len(token)) as size
             from pieces join word_vocab using (token) group by word, pos),
    steps as (select p.word, p.pos, coalesce(b.token_id, {UNKNOWN_ID}) as token_id, p.pos + coalesce(size, 1) as nxt
              from places p left join best b on b.word = p.word and b.pos = p.pos),
    walk as (
        select word, pos, token_id, nxt from steps where pos = 1
        union all
        select s.word, s.pos, s.token_id, s.nxt from walk w join steps s on s.word = w.word and s.pos = w.nxt),
    encoded as (select word, string_agg(token_id, ',' order by pos) as ids from walk group by 1),
    spaces as (select coalesce(max(token_id), {UNKNOWN_ID}) as space from base_vocab where token = ' '),
    parts as (select id, n, concat_ws(',', case when n > 0 then space end, ids) as part
              from (select id, unnest(string_split(text, ' ')) as word,
                           unnest(range(0, len(string_split(text, ' ')))) as n from clips) c
              left join encoded using (word), spaces)
    select id, coalesce(string_agg(nullif(part, ''), ',' order by n), '') as token_ids from parts group by 1)"""
_BATCHES = f"""(
    select id, length, batch_no, count(*) over b as batch_rows, max(length) over b as batch_length,
           case when max(length) over b = 0 then 0.0
                else cast(max(length) over b - length as double) / max(length) over b end as padding_share
    from (select *, cast(sum(case when pos % capacity = 0 then 1 else 0 end) over (order by length, id) as bigint) - 1 as batch_no
          from (select *, greatest({BATCH_TOKENS} // ((band + 1) * {BAND_WIDTH}), 1) as capacity,
                       row_number() over (partition by band order by length, id) - 1 as pos
                from (select id, 2 * len(text) as length, (greatest(2 * len(text), 1) - 1) // {BAND_WIDTH} as band
                      from clips where len(text) <= {MAX_TEXT} and len(text) <= {MAX_SPEECH})))
    window b as (partition by batch_no))"""

ORACLE = {
    "q_token_encode": views.sql(_ENCODED, "clips", "base_vocab"),
    "q_batch_plan": views.sql(f"select * from {_BATCHES}", "clips"),
    "q_batch_summary": views.sql(
        f"""select samples, batches, tokens, padded_tokens, (batches + 7) // 8 as steps, (batches + 7) // 8 * 10 as run_steps
            from (select count(*) as samples, max(batch_no) + 1 as batches, cast(sum(length) as bigint) as tokens,
                         cast(sum(batch_length) as bigint) as padded_tokens from {_BATCHES})""",
        "clips",
    ),
    "q_char_inventory": views.sql("select token, n from corpus_chars", "corpus_chars"),
    "q_distinct_chars": views.sql("select token from corpus_chars", "corpus_chars"),
    "q_script_chars": views.sql(
        f"select token from corpus_chars where unicode(token) between {SCRIPT[0]} and {SCRIPT[1]}",
        "corpus_chars",
    ),
    "q_vocab_new": views.sql(f"select token from {_EXTENDED} where added", "base_vocab"),
    "q_vocab_extend": views.sql(f"select * from {_EXTENDED}", "base_vocab"),
    "q_vocab_stats": views.sql(
        f"select max(token_id) as max_token_id, count(*) as vocab_size from {_EXTENDED}",
        "base_vocab",
    ),
    "q_char_encode": views.sql(
        f"""select id, string_agg(coalesce(token_id, {UNKNOWN_ID}), ',' order by pos) as token_ids
            from (select id, unnest(string_split(text, '')) as token,
                         unnest(range(0, len(string_split(text, '')))) as pos from clips) c
            left join base_vocab v using (token)
            group by 1""",
        "clips",
        "base_vocab",
    ),
    "q_prompt_slice": views.sql(
        f"""select id, array_to_string(speech_tokens[1:{PROMPT_LEN}], ',') as prompt_tokens
            from token_samples""",
        "token_samples",
    ),
    "q_label_mask": views.sql(
        f"""select id, array_to_string([case when i <= {PROMPT_LEN} then -100 else x end
                                        for x, i in list_append(speech_tokens, {STOP_ID})], ',') as labels
            from token_samples""",
        "token_samples",
    ),
    "q_append_stop": views.sql(
        f"""select id, array_to_string(list_append(speech_tokens, {STOP_ID}), ',') as target_tokens
            from token_samples""",
        "token_samples",
    ),
    "q_cond_dropout": views.sql(
        f"""select id, {_DROPPED} as cond_dropped,
                   array_to_string([case when {_DROPPED} then 0 else x end
                                    for x in speech_tokens[1:{PROMPT_LEN}]], ',') as prompt_tokens,
                   case when {_DROPPED} then 0.0 else cast(len(id) * 6 as double) end as emb_sum
            from token_samples""",
        "token_samples",
    ),
    "q_length_limits": views.sql(
        f"""select id, cast(len(text) as int) as text_len from clips
            where len(text) <= {MAX_TEXT} and len(text) <= {MAX_SPEECH}""",
        "clips",
    ),
    "q_length_cut": views.sql(
        f"""select id, cast(least(len(text), {MAX_TEXT}) as int) as text_len,
                   cast(least(len(text), {MAX_SPEECH}) as int) as speech_len
            from clips""",
        "clips",
    ),
    "q_over_limit": views.sql(
        f"""select language, count(*) filter (len(text) > {MAX_TEXT}) as text_over,
                   count(*) filter (len(text) > {MAX_SPEECH}) as speech_over,
                   count(*) filter (len(text) <= {MAX_TEXT}) as within
            from clips group by 1""",
        "clips",
    ),
    "q_mean_vector": f"select pos, {_MEAN} as mean from {_ELEMENTS} group by 1",
    "q_group_mean_vector": f"select label, pos, {_MEAN} as mean from {_ELEMENTS} group by 1, 2",
    "q_vocab_vectors": views.sql(
        f"""select vec_id as token_id, false as added, pos, round(cast(x as double), 9) as value from {_ELEMENTS}
            union all
            select token_id + 1000000, true, pos, mean
            from (select cast(token_id as bigint) as token_id from {_EXTENDED} where added),
                 (select pos, {_MEAN} as mean from {_ELEMENTS} group by 1)""",
        "base_vocab",
    ),
}
