"""The audit history of runs: appended rows, lookups, and the rows alerts and lineage are made of."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partload.functions.times import seconds_between
from partload.operators.reconcile import MISMATCH, SUCCESS
from partload.sources import rows, storage

log = logging.getLogger(__name__)

# So many dates are named in a filter; runs of more dates are compared with the whole history.
_DATES = 1000

# Microseconds are kept; the default of JSON files is milliseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

AUDIT_SCHEMA = (
    "run_id string, job_name string, processing_date string, source_schema string, "
    "source_table string, target_schema string, target_table string, source_row_count bigint, "
    "target_row_count bigint, status string, loader string, reported_count bigint, "
    "error_detail string, start_time timestamp, end_time timestamp, duration_seconds double"
)
AUDIT_COLUMNS = tuple(part.split(" ")[0] for part in AUDIT_SCHEMA.split(", "))


def audit_rows(df: DataFrame) -> DataFrame:
    """Complete run rows: a random run id where there is none, and the duration."""
    run_id = F.coalesce(F.col("run_id"), F.uuid()) if "run_id" in df.columns else F.uuid()
    done = df.withColumn("run_id", run_id).withColumn(
        "duration_seconds", seconds_between(F.col("start_time"), F.col("end_time"))
    )
    return done.select(*AUDIT_COLUMNS)


@dataclass(frozen=True)
class Sink:
    """Where audit rows go. A sink without `read` takes rows but answers no lookups."""

    name: str
    write: Callable[[DataFrame], None]
    read: Callable[[], DataFrame] | None = None


def file_sink(spark: SparkSession, path: str, file_format: str = "json") -> Sink:
    """Rows appended to a folder of JSON lines (or parquet), one directory per processing date.

    A lookup of one date reads that directory only. Unreadable JSON lines are skipped.
    """

    def read() -> DataFrame:
        if not storage.exists(spark, path):
            return rows.empty(spark, AUDIT_SCHEMA)
        reader = spark.read.schema(AUDIT_SCHEMA)
        if file_format == "json":
            reader = reader.options(mode="DROPMALFORMED", **_JSON)
        return reader.format(file_format).load(path).select(*AUDIT_COLUMNS)

    def write(df: DataFrame) -> None:
        options = _JSON if file_format == "json" else {}
        writer = df.write.mode("append").options(**options).partitionBy("processing_date")
        writer.format(file_format).save(path)

    return Sink(f"{file_format}:{path}", write, read)


def jdbc_sink(spark: SparkSession, source, table: str) -> Sink:
    """Rows appended to a database table of a sources.jdbc.JdbcSource."""
    return Sink(
        f"jdbc:{table}", lambda df: source.append(df, table), lambda: source.table(spark, table)
    )


def _unrecorded(runs: DataFrame, sink: Sink) -> DataFrame:
    """The runs whose run_id the sink does not have; their dates are all it is asked for."""
    if sink.read is None:
        return runs
    dates = [r[0] for r in runs.select("processing_date").distinct().limit(_DATES + 1).collect()]
    known = sink.read()
    if len(dates) <= _DATES:
        listed = [d for d in dates if d is not None]
        known = known.where(F.col("processing_date").isin(listed) | F.col("processing_date").isNull())
    # Stored, because a table cannot be read while it is appended to.
    fresh = runs.join(known.select("run_id").distinct(), "run_id", "left_anti").select(*runs.columns)
    return storage.materialise(fresh.dropDuplicates(["run_id"]), "fresh")


class AuditLog:
    """Fans rows out to every sink. A failing sink is logged and does not stop the others."""

    def __init__(self, sinks: Sequence[Sink]):
        if not any(s.read for s in sinks):
            raise ValueError("an audit log needs at least one sink that answers lookups")
        self.sinks = tuple(sinks)
        self._turn = threading.Lock()

    def record(self, runs: DataFrame) -> list[str]:
        """Write rows to all sinks; returns the names of those that failed.

        Rows are stored once first, so that every sink gets the same run ids. A sink that can be read
        takes only runs it does not have, so recording again after a half-known failure leaves one
        row for each run_id. Writers of one log take turns: appends to one folder must not overlap.
        """
        if len(self.sinks) > 1:
            runs = storage.materialise(runs, "audit")
        failed = []
        with self._turn:
            for sink in self.sinks:
                try:
                    sink.write(_unrecorded(runs, sink))
                except Exception as error:  # noqa: BLE001
                    log.error("audit sink %s failed: %s", sink.name, error)
                    failed.append(sink.name)
        return failed

    def read(self) -> DataFrame:
        """The history of the first sink that answers lookups."""
        return next(s.read for s in self.sinks if s.read)()

    def find_success(self, job_name: str, processing_date: str) -> bool:
        found = self.read().where(
            (F.col("job_name") == job_name)
            & (F.col("processing_date") == processing_date)
            & (F.col("status") == SUCCESS)
        )
        return not found.limit(1).isEmpty()


def already_succeeded(
    candidates: DataFrame,
    history: DataFrame,
    key: Sequence[str] = ("job_name", "processing_date"),
) -> DataFrame:
    """The candidates whose run has already succeeded."""
    done = history.where(F.col("status") == SUCCESS).select(*key).distinct()
    return candidates.join(done, list(key), "left_semi")


def run_history(history: DataFrame, by: str = "target_table") -> DataFrame:
    """Per table: runs, mismatches, date of the last run."""
    return history.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.coalesce(F.sum((F.col("status") == MISMATCH).cast("bigint")), F.lit(0)).alias(
            "mismatch_count"
        ),
        F.max("processing_date").alias("last_date"),
    )


def run_summary(history: DataFrame) -> DataFrame:
    """Runs per status, and how many of them are not a success."""
    return history.groupBy("status").agg(
        F.count(F.lit(1)).alias("run_count"),
        F.count_if(F.col("status") != SUCCESS).alias("failure_count"),
    )


def alert_message() -> Column:
    text = F.format_string(
        "%s: %s/%s (source=%d target=%d)",
        F.upper("status"), "job_name", "processing_date", "source_row_count", "target_row_count",
    )
    detail = F.nullif(F.col("error_detail"), F.lit(""))
    return F.concat(
        text, F.coalesce(F.concat(F.lit(" - "), F.substring(detail, 1, 100)), F.lit(""))
    )


def alert_rows(history: DataFrame) -> DataFrame:
    """One message per run that did not succeed."""
    return history.where(F.col("status") != SUCCESS).select(
        "run_id", "job_name", "processing_date", "status", alert_message().alias("message")
    )


def lineage_rows(
    history: DataFrame, source_namespace: str = "source", target_namespace: str = "target",
    namespace: str = "partload",
) -> DataFrame:
    """One lineage event per run: state, input and output names, and the event as JSON."""
    state = F.when(F.col("status") == SUCCESS, "COMPLETE").otherwise("FAIL")
    source = F.concat_ws(".", "source_schema", "source_table")
    target = F.concat_ws(".", "target_schema", "target_table")
    error = F.when(
        F.col("error_detail").isNotNull(),
        F.struct(F.struct(F.col("error_detail").alias("message")).alias("errorMessage")),
    )
    event = F.to_json(
        F.struct(
            state.alias("eventType"),
            F.col("end_time").alias("eventTime"),
            F.struct(F.col("run_id").alias("runId"), error.alias("facets")).alias("run"),
            F.struct(F.lit(namespace).alias("namespace"), F.col("job_name").alias("name")).alias("job"),
            F.array(
                F.struct(F.lit(source_namespace).alias("namespace"), source.alias("name"))
            ).alias("inputs"),
            F.array(
                F.struct(F.lit(target_namespace).alias("namespace"), target.alias("name"))
            ).alias("outputs"),
        )
    )
    return history.select(
        "run_id", "job_name", state.alias("event_type"),
        source.alias("input_name"), target.alias("output_name"), event.alias("event"),
    )
