"""The curation plan: from a clip table to verdicts, kept clips and counts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipcurate.config import CurationConfig
from clipcurate.operators import pack, verdict
from clipcurate.operators.dedup import CLIP_KEY, SOURCE_ORDER, keep_first
from clipcurate.operators.funnel import funnel, funnel_of_counts, total_funnel
from clipcurate.operators.ordering import take_first
from clipcurate.operators.resume import IDS_TO_BROADCAST, among, hot_folded, not_processed, seen_ids
from clipcurate.operators.segments import single_speaker
from clipcurate.plans.increments import read_counts, record_copies
from clipcurate.schemas import BUCKET, PART
from clipcurate.session import FREE_SHUFFLES, release_scratch, settings, written
from clipcurate.sinks.tables import append_ledger
from clipcurate.sources.ledger import IN_PLACE, by_bucket, read_ledger, tasks_per_bucket


# How clips that a ledger records are left out.
Skip = Callable[[DataFrame, DataFrame, tuple[str, ...]], DataFrame]
# How new clips get their frames and sampling rates, if a scan without audio gave them none.
Measure = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class CurationResult:
    verdicts: DataFrame
    kept: DataFrame
    funnel: DataFrame


@dataclass(frozen=True)
class Curator:
    """Clips are narrow rows: id, language, text, frames, sampling_rate, src_file, src_row."""

    config: CurationConfig = CurationConfig()

    @property
    def key(self) -> tuple[str, ...]:
        """What makes a clip unique. In a run over one language the id alone does, and the shuffle that
        folds copies then also serves the joins with the ledger and the speakers."""
        languages = self.config.languages
        return ("id",) if languages is not None and len(languages) == 1 else CLIP_KEY

    def measured(
        self,
        clips: DataFrame,
        ledger: DataFrame | None = None,
        skip: Skip = not_processed,
        measure: Measure | None = None,
    ) -> DataFrame:
        """First copies of new clips, with every verdict that needs no speakers.

        With `measure`, clips come without frames and sampling rate, and only new ones are measured.
        """
        rows = verdict.in_languages(clips, self.config.languages)
        rows = take_first(rows, self.config.max_samples, *SOURCE_ORDER)
        rows = keep_first(rows, self.key)
        if ledger is not None:
            rows = skip(rows, verdict.in_languages(ledger, self.config.languages), self.key)
        if measure is not None:
            rows = measure(rows)
        return self._tested(rows)

    def _tested(self, firsts: DataFrame) -> DataFrame:
        return verdict.with_measures(firsts).withColumn(
            "verdict", verdict.measured_verdict(self.config)
        )

    def _measured_by_bucket(
        self, seen: DataFrame, ledger: DataFrame, used: list[str]
    ) -> tuple[DataFrame, int]:
        """`measured`, dealt to the buckets of the ledger, and the number of rows that are dealt; none if none is new.

        Texts are shuffled once, to their bucket, and there folded and held against the ledger. Ids are counted before,
        without texts: a few new ones are sent to the scan, which then leaves out all other rows, and an id with very
        many copies is folded where it is read. If none is new, no text is read.
        """
        ids = seen_ids(seen, verdict.in_languages(ledger, self.config.languages), self.key, used)
        new, copies = ~F.col("done"), F.col("copies")
        counts = ids.agg(F.count_if(new), F.sum(F.when(new, copies)), F.sum(copies)).first()
        clips, dealt = counts[0], [n or 0 for n in counts[1:]]
        by = (BUCKET, PART, *sorted(self.key))
        if clips <= IDS_TO_BROADCAST:
            ids, rows = ids.where(new), dealt[0]
            seen = among(seen, ids, self.key) if clips else seen.limit(0)
        else:
            rows = dealt[1]
        tasks = tasks_per_bucket(rows)
        firsts = keep_first(by_bucket(hot_folded(seen, ids, rows, self.key), tasks), by)
        if rows > dealt[0]:
            firsts = not_processed(firsts, by_bucket(ids.where("done").select(*self.key), tasks), by)
        return self._tested(firsts), rows

    def to_diarize(self, clips: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
        """The clips that pass every cheaper test, so that a model sees no others."""
        return self.passing(self.measured(clips, ledger))

    def passing(self, measured: DataFrame) -> DataFrame:
        return measured.where(F.col("verdict") == verdict.KEPT).select("id", "language", *SOURCE_ORDER)

    def verdicts(
        self,
        clips: DataFrame,
        diarization: DataFrame | None = None,
        ledger: DataFrame | None = None,
        skip: Skip = not_processed,
    ) -> DataFrame:
        return self.judged(self.measured(clips, ledger, skip), diarization)

    def judged(self, measured: DataFrame, diarization: DataFrame | None = None) -> DataFrame:
        """The verdicts of measured clips, once their speakers are known."""
        return self._judged(measured, None if diarization is None else single_speaker(diarization))

    def _judged(self, measured: DataFrame, speakers: DataFrame | None) -> DataFrame:
        rows = verdict.apply_speakers(measured, speakers, self.config.languages)
        return rows.withColumn("run_id", F.lit(self.config.run_id))

    def run(
        self,
        clips: DataFrame,
        diarization: DataFrame | None = None,
        ledger: DataFrame | None = None,
    ) -> CurationResult:
        rows = self.verdicts(clips, diarization, ledger)
        return CurationResult(rows, pack.manifest(rows), funnel(clips, rows))

    def run_and_record(
        self,
        clips: DataFrame,
        ledger_path: str,
        diarization: DataFrame | None = None,
        scanned: DataFrame | None = None,
        measured: DataFrame | None = None,
    ) -> CurationResult:
        """Append this run's verdicts to the ledger; manifest and counts are then read from it.

        Counts cover the whole ledger, so a resumed run reports the same as one that never stopped, later copies
        included. Their total is that of `scanned`, the table that the clips were chosen from. `measured`, if the
        caller has it already, are the new ones of the clips, as a table.

        On disk are at one time the ids, the speakers that fail, one shuffle of the texts of new clips and what it writes.
        """
        spark = clips.sparkSession
        scratch: list[str] = []
        with settings(spark, **FREE_SHUFFLES):
            seen = take_first(verdict.in_languages(clips, self.config.languages), self.config.max_samples, *SOURCE_ORDER)
            if self.config.max_samples:
                seen = written(seen, "seen", scratch)
            if measured is None:
                measured, rows = self._measured_by_bucket(seen, read_ledger(spark, ledger_path), scratch)
            else:
                rows = measured.count()
                measured = by_bucket(measured, tasks_per_bucket(rows))
            speakers = None
            if diarization is not None and rows:
                failing = single_speaker(diarization).where(~F.col("single_speaker")).withColumnRenamed("clip_id", "id")
                speakers = by_bucket(written(failing, "failing", scratch), tasks_per_bucket(rows))
            with settings(spark, **IN_PLACE):
                key = append_ledger(self._judged(measured, speakers), ledger_path, self.config.run_id)
            record_copies(seen, ledger_path, key)
        release_scratch(spark, scratch)
        rows = verdict.in_languages(read_ledger(spark, ledger_path), self.config.languages)
        by_language = verdict.in_languages(funnel_of_counts(read_counts(spark, ledger_path, own=key)), self.config.languages)
        counts = total_funnel(clips if scanned is None else scanned, by_language)
        return CurationResult(rows, pack.manifest(rows), counts)
