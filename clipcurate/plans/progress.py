"""Progress of a costly stage: what is finished stays finished when a worker, a job or the driver dies.

Keys are worked on in waves of units. A wave has an intent record before it starts and a commit record after its rows
are written, both in a shared folder. A later call works on the keys of committed waves no more; units that were in
flight when a driver died come alone, so that one bad unit cannot take others along again. A wave that fails is cut
down to its units, a unit that fails is halved, and a single key that fails is given up with a row that says so. Waves
of very many units are cut down in steps.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipcurate.operators.ordering import number_rows
from clipcurate.session import scratch_path, written

#: Units that are worked on in one job, if nothing is known against them.
WAVE_UNITS = 64
#: With more waves than this, a call without a limit of waves makes them larger instead: each has the cost of a job.
CALL_WAVES = 16
#: Keys of a unit, when units are stretches of a source file.
UNIT_ROWS = 2_000

INTENT, COMMIT = "intent", "commit"
_RECORDS = "wave string, state string, unit string"


def source_unit(rows: int = UNIT_ROWS):
    """The unit of a clip: a stretch of so many rows of its source file."""
    block = F.call_function("div", F.col("src_row"), F.lit(rows).cast("long"))
    return F.concat_ws("#", F.coalesce("src_file", F.lit("")), F.coalesce(block, F.lit(-1)).cast("string"))


@dataclass(frozen=True)
class Progress:
    """Records and results below one folder that all executors reach."""

    spark: SparkSession
    folder: str

    def _read(self, name: str, schema) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _record(self, wave: str, state: str, units: list[str]) -> None:
        rows = self.spark.createDataFrame([(wave, state, u) for u in units or [""]], _RECORDS)
        rows.coalesce(1).write.mode("append").parquet(f"{self.folder}/records")

    def records(self) -> DataFrame:
        return self._read("records", _RECORDS)

    def results(self, schema) -> DataFrame:
        """The rows of committed waves. What a wave wrote before it was cut off does not count."""
        columns = [f.name for f in schema.fields]
        rows = self._read("results", T.StructType([*schema.fields, T.StructField("wave", T.StringType())]))
        committed = self.records().where(F.col("state") == COMMIT).select("wave").distinct()
        return rows.join(committed, "wave", "left_semi").select(*columns)

    def in_flight(self) -> set[str]:
        """Units with an intent and no commit: at most those of the waves that drivers died in."""
        return set(self.in_flight_with())

    def in_flight_with(self) -> dict[str, int]:
        """The units in flight, each with the number of units of the smallest such wave it was in."""
        records = self.records()
        committed = records.where(F.col("state") == COMMIT).select("wave").distinct()
        open_ones = records.where(F.col("state") == INTENT).join(committed, "wave", "left_anti")
        sizes = open_ones.groupBy("wave").agg(F.count(F.lit(1)).alias("n"))
        smallest = open_ones.join(sizes, "wave").groupBy("unit").agg(F.min("n").alias("n"))
        return {r["unit"]: r["n"] for r in smallest.collect()}

    def attempt(self, keys: DataFrame, units: list[str], work: Callable[[DataFrame], DataFrame]) -> Exception | None:
        """One wave: intent, rows, commit. Gives back the failure of its job, if it fails."""
        wave = uuid.uuid4().hex
        self._record(wave, INTENT, units)
        try:
            work(keys).write.parquet(f"{self.folder}/results/wave={wave}")
        except Exception as e:
            self._record(wave, COMMIT, [])  # nothing of it is in flight, and there are no rows to count
            return e
        self._record(wave, COMMIT, units)
        return None


def run_in_units(
    keys: DataFrame,
    work: Callable[[DataFrame], DataFrame],
    give_up: Callable[[DataFrame], DataFrame],
    folder: str,
    schema,
    key: dict[str, str],
    wave_units: int = WAVE_UNITS,
    most_waves: int | None = None,
) -> DataFrame:
    """`work(keys)` for all keys that no committed wave has rows for; returns the rows of all committed waves.

    `keys` has a column `unit`. `work` gives at least one row for every key; `key` says which columns of its rows hold
    which of the keys. `give_up` gives the rows of a single key whose job fails. A call ends after `most_waves` waves,
    if that is set, and a later one goes on. If no unit at all of a wave, or none of several keys of a unit, can be
    worked on, the failure is raised, as that is not the fault of a key. Only the units of one wave come to the driver, and the keys of one unit.
    """
    spark = keys.sparkSession
    progress = Progress(spark, folder.rstrip("/"))
    found = progress.results(schema).select(*[F.col(r).alias(k) for k, r in key.items()])
    todo = written(keys.join(found, list(key), "left_anti"), "todo")
    suspects = progress.in_flight_with()
    units = todo.select("unit").distinct()
    there = sorted(r["unit"] for r in units.where(F.col("unit").isin(*suspects)).collect()) if suspects else []
    fresh = units.where(~F.col("unit").isin(*suspects)) if suspects else units
    numbered = written(number_rows(fresh, "unit", name="no"), "units")
    count = numbered.count()
    wave_size = wave_units if most_waves is not None else max(wave_units, -(-count // CALL_WAVES))
    waves = -(-count // wave_size)

    def of_units(part: DataFrame, names: list[str]) -> DataFrame:
        return part.where(F.col("unit").isin(*names))

    def halve(part: DataFrame, unit: str) -> list[tuple[DataFrame, Exception]]:
        """Finish what can be finished of keys whose job has failed; gives back each key that fails on its own."""
        rows = part.orderBy(*key).collect()
        bad = []
        for half in (rows[: len(rows) // 2], rows[len(rows) // 2 :]) if len(rows) > 1 else (rows,):
            keys_of_half = spark.createDataFrame(half, part.schema)
            failure = progress.attempt(keys_of_half, [unit], work)
            if failure is not None:
                bad += halve(keys_of_half, unit) if len(half) > 1 else [(keys_of_half, failure)]
        return bad

    def rescue(keys_there: DataFrame, unit: str) -> None:
        """Give up the keys of a unit that fail alone. If each of several does, the fault is not with the keys."""
        part = written(of_units(keys_there, [unit]), "rescue")
        several = part.limit(2).count() > 1
        bad = halve(part, unit)
        if several and len(bad) == part.count():
            raise bad[0][1]
        for single, _ in bad:
            failure = progress.attempt(single, [unit], give_up)
            if failure is not None:
                raise failure

    def in_groups(keys_there: DataFrame, groups: list[list[str]]) -> None:
        """Each group by a job of its own. One that fails is cut down further, to its units in the end."""
        failures = [progress.attempt(of_units(keys_there, names), names, work) for names in groups]
        failed = [names for names, failure in zip(groups, failures) if failure is not None]
        if len(groups) > 1 and len(failed) == len(groups) and all(len(names) == 1 for names in groups):
            raise failures[0]
        for names in failed:
            if len(names) == 1:
                rescue(keys_there, names[0])
            else:
                in_groups(keys_there, _groups(names, len(names)))

    alone = [
        group
        for size in sorted(set(suspects.values()))
        for group in _groups([name for name in there if suspects[name] == size], size)
    ]
    alone = alone if most_waves is None else alone[:most_waves]
    in_groups(todo, alone)
    left = waves if most_waves is None else min(waves, max(0, most_waves - len(alone)))
    if left:
        dealt = _dealt(todo, numbered.where(F.col("no") <= left * wave_size), wave_size)
    for wave in range(left):
        own = numbered.where(F.col("no").between(wave * wave_size + 1, (wave + 1) * wave_size))
        names = sorted(r["unit"] for r in own.select("unit").collect())
        part = dealt.where(F.col("wave") == wave).drop("wave")
        if progress.attempt(part, names, work) is not None:
            in_groups(part, _groups(names, len(names)))
    return progress.results(schema)


def _groups(names: list[str], size: int) -> list[list[str]]:
    """Units of a wave of that size that did not end, in about `WAVE_UNITS` groups: each alone, if they were not more."""
    step = -(-size // WAVE_UNITS)
    return [names[at : at + step] for at in range(0, len(names), step)]


def _dealt(todo: DataFrame, numbered: DataFrame, wave_size: int) -> DataFrame:
    """The keys of numbered units, written with a folder for each wave, so that no wave reads the keys of others."""
    spark = todo.sparkSession
    path = scratch_path(spark, "waves")
    wave = F.call_function("div", F.col("no") - 1, F.lit(wave_size).cast("long")).alias("wave")
    rows = todo.join(numbered, "unit").repartitionByRange("no").select(*todo.columns, wave)
    rows.write.partitionBy("wave").parquet(path)
    return spark.read.schema(T.StructType([*todo.schema.fields, T.StructField("wave", T.LongType())])).parquet(path)
