"""Unit state: an append-only table of events, one row per unit and change."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from partload.functions.keys import escape_value
from partload.sources import rows, storage

WRITTEN = "written"
# Hidden from the reader of the whole log.
_SNAPSHOTS, _COVERED = "_snapshots", "covered"

STATE_SCHEMA = (
    "job_name string, processing_date string, seq bigint, unit_key string, status string, "
    "records_read bigint, records_failed bigint"
)


def latest_state(
    events: DataFrame,
    key: Sequence[str] = ("job_name", "processing_date", "unit_key"),
    order: Sequence[str] = ("seq",),
) -> DataFrame:
    """The last event of every key; events without a unit key are skipped.

    An aggregate, not a window: each task keeps one row per key before the shuffle.
    """
    rest = [c for c in events.columns if c not in key]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    named = F.col(key[-1])
    return (
        events.where(named.isNotNull() & (named.cast("string") != ""))
        .groupBy(*key)
        .agg(last.alias("_last"))
        .select(*key, *[F.col(f"_last.{c}").alias(c) for c in rest])
    )


def pending_units(units: DataFrame, state: DataFrame) -> DataFrame:
    """Units to load: those of every target partition that is not written in full.

    A partition is replaced as a whole, so one unwritten unit brings back the others of its path.
    """
    written = state.where(F.col("status") == WRITTEN).select("unit_key")
    open_paths = units.join(written, "unit_key", "left_anti").select("target_path").distinct()
    return units.join(open_paths, "target_path", "left_semi").select(*units.columns)


def reused_units(units: DataFrame, state: DataFrame, pending: DataFrame) -> DataFrame:
    """Written units of finished partitions, with the counts stored for them."""
    stored = state.where(F.col("status") == WRITTEN).select(
        "unit_key", "records_read", "records_failed"
    )
    return units.join(pending.select("unit_key"), "unit_key", "left_anti").join(stored, "unit_key")


def paths_to_clear(units: DataFrame, state: DataFrame) -> DataFrame:
    """Distinct target paths that no written unit uses."""
    written = state.where(F.col("status") == WRITTEN).select("unit_key")
    protected = units.join(written, "unit_key", "left_semi").select("target_path")
    return units.select("target_path").distinct().join(protected, "target_path", "left_anti")


class StateTable:
    """Unit events of all jobs under one folder, one directory per job and date."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _dir(self, job_name: str, processing_date: str) -> str:
        return (
            f"{self.path}/job_name={escape_value(job_name)}"
            f"/processing_date={escape_value(processing_date)}"
        )

    def append(self, job_name: str, processing_date: str, units: DataFrame, status: str) -> None:
        """Add one event per unit; `units` has unit_key, row_count and perhaps records_failed."""
        failed = F.col("records_failed") if "records_failed" in units.columns else F.lit(None)
        units.select(
            F.lit(time.time_ns()).alias("seq"),
            "unit_key",
            F.lit(status).alias("status"),
            F.col("row_count").alias("records_read"),
            F.coalesce(failed, F.lit(0)).cast("bigint").alias("records_failed"),
        ).write.mode("append").json(self._dir(job_name, processing_date))

    def exists(self, job_name: str, processing_date: str) -> bool:
        return storage.exists(self.spark, self._dir(job_name, processing_date))

    def _snapshot(self, folder: str) -> tuple[int, set[str]]:
        """Number of the newest snapshot and the event files it covers; number 0 for none."""
        found = storage.list_dirs(self.spark, f"{folder}/{_SNAPSHOTS}")
        done = [int(n) for n in found if n.isdigit()]
        if not done:
            return 0, set()
        listed = storage.read_text(self.spark, f"{folder}/{_SNAPSHOTS}/{max(done)}/{_COVERED}")
        return max(done), set(listed.split("\n"))

    def latest(self, job_name: str, processing_date: str) -> DataFrame:
        """Last state per unit of one job and date; unreadable lines are skipped.

        Reads the newest snapshot and only those event files it does not cover.
        """
        folder = self._dir(job_name, processing_date)
        number, covered = self._snapshot(folder)
        tail = [n for n in storage.list_files(self.spark, folder) if n not in covered]
        return self._states(folder, number, tail)

    def compact(self, job_name: str, processing_date: str) -> int:
        """Write the last states as a new snapshot; returns how many event files it covers.

        Appends and reads may go on meanwhile: an event file the listing did not see stays part of
        the tail, and a snapshot has its name only when it is complete. Files that the snapshot
        before covered are deleted, and older snapshots; readers of that snapshot do not need them. One
        compaction of a job and date at a time.
        """
        folder = self._dir(job_name, processing_date)
        number, before = self._snapshot(folder)
        listed = storage.list_files(self.spark, folder)
        names = [n for n in listed if n not in before]
        if not names:
            return len(before)
        draft = f"{folder}/{_SNAPSHOTS}/draft-{uuid.uuid4().hex}"
        self._states(folder, number, names).write.parquet(f"{draft}/rows")
        # Names of files that are gone already need no cover any more.
        covered = sorted(listed)
        storage.write_text(self.spark, f"{draft}/{_COVERED}", "\n".join(covered))
        storage.move(self.spark, draft, f"{folder}/{_SNAPSHOTS}/{number + 1}")
        for name in before:
            storage.delete_prefix(self.spark, f"{folder}/{name}")
        for n in range(number - 1, 0, -1):
            if not storage.delete_prefix(self.spark, f"{folder}/{_SNAPSHOTS}/{n}"):
                break
        return len(covered)

    def _states(self, folder: str, number: int, names: Sequence[str]) -> DataFrame:
        """Last states of a snapshot, if there is one, and of event files after it."""
        schema = STATE_SCHEMA.split(", ", 2)[2]
        events = rows.empty(self.spark, schema)
        if names:
            reader = self.spark.read.schema(schema).option("mode", "DROPMALFORMED")
            events = reader.json([f"{folder}/{n}" for n in names])
        if number:
            snapshot = self.spark.read.schema(schema).parquet(f"{folder}/{_SNAPSHOTS}/{number}/rows")
            events = events.unionByName(snapshot)
        return latest_state(events, ("unit_key",)).select(*events.columns)

    def events(self) -> DataFrame:
        """Every event of every job that no compaction has deleted as superseded."""
        reader = self.spark.read.schema(STATE_SCHEMA).option("mode", "DROPMALFORMED")
        try:
            return reader.json(self.path)
        except AnalysisException:
            if storage.exists(self.spark, self.path):
                raise
            return rows.empty(self.spark, STATE_SCHEMA)

    def clear(self, job_name: str, processing_date: str) -> int:
        return storage.delete_prefix(self.spark, self._dir(job_name, processing_date))
