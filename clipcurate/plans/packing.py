"""Packing that goes on: clips kept later fill the last shard up and open new ones; full shards are never touched.

A call has a number, its generation. Before it writes shards it leaves an intent record, and afterwards the rows of a
last shard that is not full (its tail) and a commit record. A call that was cut off is undone by the next one: its
shards are rewritten or deleted, and the last shard starts again from the committed tail.

Within a generation clips are in pack order, so the first key of each shard tells the shard of any clip. With these
limits and the places of the wanted clips on every executor, audio that is not wanted is left out where it is read,
and the rest is shuffled once, to its shard. Both tables are counted first; where they are too large to be sent, audio
is joined by its place and shuffled a second time, with the same rows as the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipcurate.config import SHARD_ROWS
from clipcurate.functions.names import shard_name
from clipcurate.operators import pack
from clipcurate.schemas import CLEAN_CLIP
from clipcurate.session import delete_folder, written
from clipcurate.session import settings as _settings
from clipcurate.sinks import tables

# Folders below `packing` in an output root.
RECORDS, TAILS, LIMITS = "records", "tails", "limits"
INTENT, COMMIT = "intent", "commit"

# What may be sent to every executor; beyond it, audio is joined by its place instead.
LIMITS_TO_BROADCAST = 500_000
PLACE_BYTES_TO_BROADCAST = 64 << 20

# Shard folders are listed by this many tasks a core.
LISTING_TASKS_PER_CORE = 4

# Shards of about 300 MB that one task writes, unless there are few.
SHARDS_PER_TASK = 8

PLACE = ("src_file", "src_row", "language", "id")
_NARROW = (*PLACE, "text", "speaker", "duration_ms", "cps", "shard_id", "row_no")
_WORD, _WORDS = 64, 64
_RECORD = "generation int, state string, rows long, end_shard long"


@dataclass(frozen=True)
class Packed:
    """What is committed: the last generation, its rows, and the end of shards that a cut-off call may have written."""

    generation: int = 0
    rows: int = 0
    open_end: int | None = None


def _folder(out: str, name: str) -> str:
    return f"{out.rstrip('/')}/packing/{name}"


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """Reads a table that may not be there. Folders are listed here, by some tasks a core and not by one task a shard."""
    tasks = LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    try:
        with _settings(spark, **{"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)}):
            return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def packed_so_far(spark: SparkSession, out: str) -> Packed:
    """One aggregate over the records, of which every call leaves two."""
    records = _read(spark, _folder(out, RECORDS), _RECORD)
    committed = F.col("state") == COMMIT
    last = F.max(F.when(committed, F.struct("generation", "rows")))
    begun = F.collect_list(F.when(~committed, F.struct("generation", "end_shard")))
    row = records.agg(last.alias("last"), begun.alias("begun")).first()
    generation, rows = row["last"] or (0, 0)
    ends = [r["end_shard"] for r in row["begun"] if r["generation"] > generation]
    return Packed(generation, rows, max(ends) if ends else None)


def _record(spark: SparkSession, out: str, generation: int, state: str, rows: int, end_shard: int) -> None:
    row = spark.createDataFrame([(generation, state, rows, end_shard)], _RECORD)
    row.coalesce(1).write.mode("append").parquet(_folder(out, RECORDS))


def start_over(spark: SparkSession, out: str) -> None:
    """Forget the records and delete the shards."""
    for path in (_folder(out, ""), f"{out.rstrip('/')}/{tables.SHARD_FOLDER}"):
        delete_folder(spark, path)


def read_shards(spark: SparkSession, out: str, fields: list[T.StructField]) -> DataFrame:
    """Written rows with their `shard`, the folder name, and `shard_no` from it; filters on it prune folders. None if nothing is written."""
    schema = T.StructType([*fields, T.StructField("shard", T.StringType())])
    rows = _read(spark, f"{out.rstrip('/')}/{tables.SHARD_FOLDER}", schema)
    return rows.withColumn("shard_no", F.expr("cast(substring(shard, 7) as bigint)"))


def _tail(spark: SparkSession, out: str, generation: int) -> DataFrame:
    """Rows of the last shard of a generation, with their row numbers; none if that shard was full."""
    schema = T.StructType([*CLEAN_CLIP.fields, T.StructField("row_no", T.LongType())])
    return _read(spark, f"{_folder(out, TAILS)}/generation={generation}", schema)


def shard_limits(numbered: DataFrame) -> DataFrame:
    """The first id of each language in each shard: one row per shard, and one more where a language begins in it."""
    return numbered.groupBy("language", "shard_id").agg(F.min("id").alias("first_id"))


def _limit_lists(limits: DataFrame, count: int) -> DataFrame:
    """One row per language: its limits in order, in blocks of about the square root of their number."""
    step = max(1, round(count**0.5))
    entry = F.struct("first_id", "shard_id")
    lists = limits.groupBy("language").agg(F.sort_array(F.collect_list(entry)).alias("_all"))
    starts = F.sequence(F.lit(1), F.size("_all"), F.lit(step))
    blocks = F.transform(starts, lambda at: F.slice("_all", at, F.lit(step)))
    return lists.select("language", blocks.alias("_blocks"))


def _shard_of(key: Column) -> Column:
    """The shard of the last limit that is not after `key`; no shard if all are."""
    upto = lambda entries, first: F.size(F.filter(entries, lambda e: first(e) <= key))
    block = F.get("_blocks", upto(F.col("_blocks"), lambda b: b[0]["first_id"]) - 1)
    return F.get(block, upto(block, lambda e: e["first_id"]) - 1)["shard_id"]


def _place_words(rows: DataFrame) -> DataFrame:
    """Wanted source rows as bits: 64 rows to a word, up to 64 words to a row of this table."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("src_row") % _WORD).cast("int"))
    words = rows.groupBy("src_file", F.expr(f"src_row div {_WORD}").alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    return words.groupBy("src_file", F.expr(f"_word div {_WORDS}").alias("_block")).agg(
        F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_words")
    )


def at_places(audio: DataFrame, rows: DataFrame) -> DataFrame | None:
    """The rows of `audio` at the places of `rows`, found without a shuffle of audio; None if the places are too many."""
    places = written(_place_words(rows), "places")
    # A word and its number take 16 bytes; a row has the file's name and what the hash table adds to it.
    size = F.sum(F.octet_length("src_file") + 16 * F.size("_words") + 100)
    if (places.agg(size.alias("b")).first()["b"] or 0) > PLACE_BYTES_TO_BROADCAST:
        return None
    block = F.expr(f"src_row div {_WORD * _WORDS}")
    word = F.try_element_at("_words", F.expr(f"src_row div {_WORD}"))
    bit = F.call_function("shiftrightunsigned", word, (F.col("src_row") % _WORD).cast("int")).bitwiseAND(F.lit(1))
    found = audio.withColumn("_block", block).join(F.broadcast(places), ["src_file", "_block"]).where(bit == 1)
    return found.select(*audio.columns)


def wanted_audio(audio: DataFrame, numbered: DataFrame) -> DataFrame | None:
    """The audio of numbered clips with its `shard_id`, found without a shuffle of audio.

    None if the limits or the places are too many to be sent to every executor.
    """
    limits = written(shard_limits(numbered), "limits")
    count = limits.count()
    found = None if count > LIMITS_TO_BROADCAST else at_places(audio.select(*PLACE, "audio"), numbered)
    if found is None:
        return None
    lists = F.broadcast(_limit_lists(limits, count))
    return found.join(lists, "language").select(*PLACE, "audio", _shard_of(F.col("id")).alias("shard_id"))


# Both sides of the join lie by shard already, so its other keys ask for no further shuffle; a shard is never split,
# as it becomes one file. Also: only the folders that are written are replaced.
WRITE_SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.adaptive.skewJoin.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def shard_rows_of(audio: DataFrame, numbered: DataFrame, tail: DataFrame, shards: int) -> DataFrame:
    """Packed rows lying by shard, a whole shard in one task; plan and run it under `WRITE_SETTINGS`.

    Rows of the tail go along as clips whose place is the tail.
    """
    spark = numbered.sparkSession
    tasks = max(min(shards, spark.sparkContext.defaultParallelism), -(-shards // SHARDS_PER_TASK), 1)
    rows = numbered.select(*_NARROW).unionByName(tail.select(*_NARROW))
    found = wanted_audio(audio, numbered)
    if found is None:
        audio = audio.select(*PLACE, "audio").unionByName(tail.select(*PLACE, "audio"))
        return tables.packed_rows(rows, audio).repartition(tasks, "shard_id")
    keys = ("shard_id", *PLACE)
    found = found.unionByName(tail.select(*keys, "audio")).repartition(tasks, "shard_id")
    return tables.packed_rows(rows.repartition(tasks, "shard_id").hint("shuffle_hash"), found, keys)


def _as_clips(tail: DataFrame, shard: int) -> DataFrame:
    return tail.select(
        *PLACE[2:],
        "audio",
        "text",
        F.col("speaker_id").alias("speaker"),
        F.round(F.col("duration_sec") * 1000).cast("long").alias("duration_ms"),
        "cps",
        F.lit("").alias("src_file"),
        F.col("row_no").alias("src_row"),
        F.lit(shard).cast("long").alias("shard_id"),
        "row_no",
    )


def _write(rows: DataFrame, out: str) -> None:
    """One snappy file per shard, in row order; folders of other shards stay as they are."""
    columns = [F.col(f.name).cast(f.dataType) for f in CLEAN_CLIP.fields]
    (
        rows.withColumn("shard", shard_name(F.col("shard_id")))
        .sortWithinPartitions("shard", "row_no")
        .select(*columns, "shard")
        .write.mode("overwrite")
        .option("compression", "snappy")
        .partitionBy("shard")
        .parquet(f"{out.rstrip('/')}/{tables.SHARD_FOLDER}")
    )


def append_clips(kept: DataFrame, audio: DataFrame, out: str, shard_rows: int = SHARD_ROWS) -> Packed:
    """Pack those of `kept` that are in no shard yet; gives back what is packed now.

    `kept` has one narrow row per clip whose recording is in `audio` (language, id and place not null). Without new
    clips nothing is written, unless a call that was cut off has to be undone. Rows of `audio` that no kept clip names
    are ignored, also the further copies of a clip. A recording that is not found is an error before the commit.
    """
    spark = kept.sparkSession
    state = packed_so_far(spark, out)
    full = state.rows // shard_rows
    keys = [f for f in CLEAN_CLIP.fields if f.name in pack.PACK_ORDER]
    tail = _tail(spark, out, state.generation)
    packed = read_shards(spark, out, keys).where(F.col("shard_no") < full).select(*pack.PACK_ORDER)
    packed = packed.unionByName(tail.select(*pack.PACK_ORDER))
    new = written(kept.join(packed, list(pack.PACK_ORDER), "left_anti"), "new-clips")
    count = new.count()
    if count == 0 and state.open_end is None:
        return state
    numbered = written(pack.assign_shards(new, shard_rows, after=state.rows), "sharded")
    rows, generation = state.rows + count, state.generation + 1
    end = -(-rows // shard_rows)
    shard_limits(numbered).write.mode("overwrite").parquet(f"{_folder(out, LIMITS)}/generation={generation}")
    _record(spark, out, generation, INTENT, rows, max(end, state.open_end or 0))
    with _settings(spark, **WRITE_SETTINGS):
        _write(shard_rows_of(audio, numbered, _as_clips(tail, full), end - full), out)
    for number in range(end, state.open_end or 0):
        name = spark.range(1).select(shard_name(F.lit(number))).first()[0]
        delete_folder(spark, f"{out.rstrip('/')}/{tables.SHARD_FOLDER}/shard={name}")
    _commit(spark, out, Packed(generation, rows), shard_rows, full)
    return Packed(generation, rows)


def _commit(spark: SparkSession, out: str, state: Packed, shard_rows: int, first: int) -> None:
    """Count the shards written, keep the tail, and record that the generation is done."""
    found = read_shards(spark, out, CLEAN_CLIP.fields[:1]).where(F.col("shard_no") >= first).count()
    if found != state.rows - first * shard_rows:
        raise RuntimeError(f"the shards from {first} on hold {found} clips instead of {state.rows - first * shard_rows}")
    last = state.rows // shard_rows
    # A shard is one file in row order.
    number = F.lit(last * shard_rows + 1).cast("long") + F.col("_metadata.row_index")
    columns = [f.name for f in CLEAN_CLIP.fields]
    tail = read_shards(spark, out, CLEAN_CLIP.fields).where(F.col("shard_no") == last).select(*columns, number.alias("row_no"))
    tail.write.mode("overwrite").parquet(f"{_folder(out, TAILS)}/generation={state.generation}")
    _record(spark, out, state.generation, COMMIT, state.rows, -(-state.rows // shard_rows))
