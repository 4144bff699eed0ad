"""Ledger tables and ledger documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipcurate.functions.names import path_stem
from clipcurate.operators.verdict import KEPT
from clipcurate.schemas import BUCKET, BUCKETS, DUPLICATES, GENERATIONS, LEDGER, LEDGER_DOCUMENT, PART, RUN_KEY


#: Folders beside a ledger: later copies, partial counts, and what compacted folders stand for.
DUPLICATES_SUFFIX, COUNTS_SUFFIX, GENERATIONS_SUFFIX = "-duplicates", "-counts", "-generations"
#: Run keys of compacted folders begin with this.
GENERATION = "generation-"
#: Above so many rows a bucket is dealt to several tasks, which write a file each.
ROWS_PER_TASK = 100_000
#: For tables that `by_bucket` has dealt: a join that has further keys asks for no further shuffle.
IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def bucket_of(clip_id: Column) -> Column:
    """The bucket of an id. A null id is in the first."""
    return F.coalesce(F.pmod(F.crc32(clip_id.cast("binary")), F.lit(BUCKETS)), F.lit(0)).cast("int")


def tasks_per_bucket(rows: int) -> int:
    return max(1, -(-rows // (BUCKETS * ROWS_PER_TASK)))


def by_bucket(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows shuffled to the bucket of their id, and in it to one of `tasks` parts by another hash of the id.

    Tables dealt by the same number lie side by side: with `IN_PLACE`, grouping or joining them by bucket, part and id
    takes no further shuffle, nor does writing them to a ledger.
    """
    placed = rows.withColumns({BUCKET: bucket_of(F.col("id")), PART: F.pmod(F.hash("id"), F.lit(tasks))})
    return placed.repartition(BUCKET, PART)


def beside(path: str, suffix: str) -> str:
    return path.rstrip("/") + suffix


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table that may not be there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_generations(spark: SparkSession, path: str) -> dict[str, set[str]]:
    """The run folders that each compacted folder stands for: a row per folder that was compacted."""
    found: dict[str, set[str]] = {}
    for r in read_or_empty(spark, beside(path, GENERATIONS_SUFFIX), GENERATIONS).collect():
        found.setdefault(r["generation"], set()).add(r["run_key"])
    return found


def stored_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a ledger with their `run_key` and `bucket`.

    Folders that a recorded generation stands for do not count, nor does a generation that was never recorded.
    """
    layout = [T.StructField(RUN_KEY, T.StringType()), T.StructField(BUCKET, T.IntegerType())]
    rows = read_or_empty(spark, path, T.StructType([*LEDGER.fields, *layout]))
    generations = read_generations(spark, path)
    old = set().union(*generations.values())
    key = F.col(RUN_KEY)
    return rows.where(
        ~key.isin(*old) & (~F.startswith(key, F.lit(GENERATION)) | key.isin(*generations))
    )


def read_ledger(
    spark: SparkSession, path: str, without: str | None = None, buckets: list[int] | None = None
) -> DataFrame:
    """All verdict rows so far, of runs and micro-batches alike; no ledger yet means no rows.

    A writer that may run again leaves out its own rows by its key. With `buckets`, only their files are read.
    """
    rows = stored_ledger(spark, path)
    if without is not None:
        rows = rows.where(~F.col(RUN_KEY).eqNullSafe(without))
    if buckets is not None:
        rows = rows.where(F.col(BUCKET).isin(*buckets))
    return rows.drop(RUN_KEY, BUCKET)


def read_duplicates(spark: SparkSession, path: str, without: str | None = None) -> DataFrame:
    """Where later copies of recorded clips lie."""
    schema = T.StructType([*T._parse_datatype_string(DUPLICATES).fields, T.StructField(RUN_KEY, T.StringType())])
    rows = read_or_empty(spark, beside(path, DUPLICATES_SUFFIX), schema)
    if without is not None:
        rows = rows.where(~F.col(RUN_KEY).eqNullSafe(without))
    return rows.drop(RUN_KEY)


def _documents(spark: SparkSession, path: str, one_per_line: bool) -> DataFrame:
    return spark.read.schema(LEDGER_DOCUMENT).option("multiLine", not one_per_line).json(path)


def read_ledger_documents(
    spark: SparkSession, path: str, language: str, one_per_line: bool = False
) -> DataFrame:
    """Ledger rows from JSON documents, one per file or one per line; a missing list reads as empty.

    A document names the ids it has processed and the entries it kept. Which test the other ids failed is
    not in it, so their verdict is null. An entry counts as processed even where its id is not listed; of repeated
    entries of an id the longest clip stays, and of equally long ones the first text in order.
    """
    docs = _documents(spark, path, one_per_line)
    kept = docs.select(F.explode("metadata").alias("m")).select(
        path_stem(F.col("m.wav_path")).alias("id"),
        F.lit(KEPT).alias("verdict"),
        F.col("m.text").alias("clean_text"),
        F.col("m.speaker").alias("speaker"),
        F.col("m.duration").alias("duration"),
        F.col("m.cps").alias("cps"),
    )
    best = F.max_by(F.struct(*[c for c in kept.columns if c != "id"]), F.struct("duration", "cps", "clean_text"))
    kept = kept.groupBy("id").agg(best.alias("_k")).select("id", "_k.*")
    ids = docs.select(F.explode("processed_ids").alias("id")).union(kept.select("id")).distinct()
    return ids.join(kept, "id", "left").withColumn("language", F.lit(language))


def import_ledger(
    spark: SparkSession, path: str, language: str, run_id: str = "import", one_per_line: bool = False
) -> DataFrame:
    """Ledger documents as rows of a ledger table, to be written by `append_ledger` and resumed from.

    Copies count as one, and the source position is not known: such clips are not packed from a raw folder.
    """
    rows = read_ledger_documents(spark, path, language, one_per_line).withColumns(
        {
            "copies": F.lit(1),
            "src_file": F.lit(None),
            "src_row": F.lit(None),
            "duration_ms": F.floor(F.col("duration").cast("decimal(38,9)") * 1000 + F.lit(0.5).cast("decimal(2,1)")),
            "run_id": F.lit(run_id),
        }
    )
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER.fields])


def read_ledger_stats(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """The counters of each document; a missing counter reads as 0."""
    return _documents(spark, path, one_per_line).select("stats.*").na.fill(0)
