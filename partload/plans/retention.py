"""Retention over events kept as dated partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from partload.operators import loading, retention
from partload.plans.inputs import table
from partload.sources import storage
from partload.spec import DATE_COLUMN

TODAY = dt.date(2024, 1, 31)
DAYS = 10


def _daily(spark, sf_dir):
    """Events written under one directory per day; returns the folder and the stored schema."""
    events = table(spark, sf_dir, "events").withColumn(
        DATE_COLUMN, F.date_format("ts", "yyyy-MM-dd")
    )
    path = storage.scratch_dir(spark) + "/events"
    loading.write_target(loading.arrange(events, [DATE_COLUMN]), path)
    return path, events.schema


def dated_partitions(spark, sf_dir):
    """Dates, files and rows found in the directories of a daily load."""
    path, schema = _daily(spark, sf_dir)
    stored = loading.read_target(spark, path, "parquet", schema)
    return storage.dated_row_counts(stored).select("partition_date", "row_count")


def _by_type(spark, sf_dir):
    """Dates of every event type, each type with its own retention; views are never expired."""
    events = table(spark, sf_dir, "events")
    dates = events.groupBy("event_type", F.to_date("ts").alias("partition_date")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    days = (
        F.when(F.col("event_type") == "click", 5)
        .when(F.col("event_type") == "error", 0)
        .when(F.col("event_type") == "purchase", 20)
        .when(F.col("event_type") == "signup", 365)
    )
    return retention.retention_plan(dates, TODAY, days)


def retention_plan(spark, sf_dir):
    return _by_type(spark, sf_dir)


def retention_summary(spark, sf_dir):
    plan = _by_type(spark, sf_dir)
    return retention.retention_summary(plan)


def retention_apply(spark, sf_dir):
    """Rows per date left after the expired dates were deleted."""
    path, schema = _daily(spark, sf_dir)
    listed = storage.list_dated_partitions(spark, path)
    plan = retention.retention_plan(listed, TODAY, DAYS)
    retention.apply_retention(spark, plan, dry_run=False)
    left = loading.read_target(spark, path, "parquet", schema)
    return left.groupBy(DATE_COLUMN).agg(F.count(F.lit(1)).alias("row_count"))


def retention_dry_run(spark, sf_dir):
    """What a dry run reports, with the rows that are still there."""
    path, schema = _daily(spark, sf_dir)
    listed = storage.list_dated_partitions(spark, path)
    done = retention.apply_retention(spark, retention.retention_plan(listed, TODAY, DAYS))
    stored = storage.dated_row_counts(loading.read_target(spark, path, "parquet", schema))
    return done.join(stored, "partition_date").select(
        "partition_date", "would_delete", "objects_deleted", "row_count"
    )


QUERIES = {
    "dated_partitions": dated_partitions,
    "retention_plan": retention_plan,
    "retention_summary": retention_summary,
    "retention_apply": retention_apply,
    "retention_dry_run": retention_dry_run,
}

_PLAN = f"""
WITH dates AS (
  SELECT event_type, CAST(ts AS DATE) AS partition_date, count(*) AS row_count
  FROM events GROUP BY ALL
), plan AS (
  SELECT *, DATE '{TODAY}' - CASE event_type WHEN 'click' THEN 5 WHEN 'error' THEN 0
            WHEN 'purchase' THEN 20 WHEN 'signup' THEN 365 END AS cutoff_date
  FROM dates
), marked AS (
  SELECT event_type, partition_date, row_count, CAST(cutoff_date AS DATE) AS cutoff_date,
         CASE WHEN partition_date <= cutoff_date THEN 'expired' ELSE 'kept' END AS action
  FROM plan
)"""

ORACLES = {
    "dated_partitions": """
SELECT CAST(ts AS DATE) AS partition_date, count(*) AS row_count FROM events GROUP BY ALL""",
    "retention_plan": _PLAN + " SELECT * FROM marked",
    "retention_summary": _PLAN + """
SELECT count(*) FILTER (WHERE action = 'kept') AS kept_count,
       count(*) FILTER (WHERE action = 'expired') AS expired_count, false AS had_errors
FROM marked""",
    "retention_apply": f"""
SELECT strftime(ts, '%Y-%m-%d') AS processing_date, count(*) AS row_count FROM events
WHERE CAST(ts AS DATE) > DATE '{TODAY}' - {DAYS} GROUP BY ALL""",
    "retention_dry_run": f"""
SELECT CAST(ts AS DATE) AS partition_date, true AS would_delete, CAST(0 AS BIGINT) AS objects_deleted,
       count(*) AS row_count
FROM events WHERE CAST(ts AS DATE) <= DATE '{TODAY}' - {DAYS} GROUP BY ALL""",
}
