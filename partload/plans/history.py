"""Audit history and unit state, with one run per user and day of the event stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from partload.operators import audit, state
from partload.plans.inputs import table
from partload.sources import storage


def _runs(spark, sf_dir):
    """One run row per user and day. Errors are lost rows; a day of errors only is a failed run."""
    events = table(spark, sf_dir, "events")
    grouped = events.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("processing_date")).agg(
        F.count(F.lit(1)).alias("source_row_count"),
        F.count_if(F.col("event_type") != "error").alias("target_row_count"),
        F.max("event_id").alias("last_event"),
        F.min("ts").cast("timestamp").alias("start_time"),
        F.max("ts").cast("timestamp").alias("end_time"),
    )
    status = F.when(F.col("target_row_count") == F.col("source_row_count"), "success").when(
        F.col("target_row_count") == 0, "failed"
    ).otherwise("dq_mismatch")
    note = F.repeat(F.concat(F.lit("event "), "last_event", F.lit(" ")), 20)
    detail = F.when(F.col("target_row_count") == 0, F.concat(F.lit("all rows refused "), note))
    return audit.audit_rows(
        grouped.select(
            F.concat(F.lit("job_"), "user_id").alias("job_name"),
            "processing_date",
            F.lit("stage").alias("source_schema"),
            F.concat(F.lit("ld_"), "user_id").alias("source_table"),
            F.lit("wh").alias("target_schema"),
            F.concat(F.lit("t_"), F.col("user_id") % 20).alias("target_table"),
            "source_row_count",
            "target_row_count",
            status.alias("status"),
            F.lit("spark").alias("loader"),
            F.col("source_row_count").alias("reported_count"),
            detail.alias("error_detail"),
            "start_time",
            "end_time",
        )
    )


def audit_append(spark, sf_dir):
    """Run rows fanned out to a failing sink and two working ones, then read back from the second."""
    def broken(_):
        raise OSError("sink is down")

    folder = storage.scratch_dir(spark)
    log = audit.AuditLog(
        [
            audit.Sink("broken", broken),
            audit.file_sink(spark, f"{folder}/json"),
            audit.file_sink(spark, f"{folder}/parquet", "parquet"),
        ]
    )
    log.record(_runs(spark, sf_dir))
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return (
        log.read()
        .withColumn("has_run_id", F.length("run_id") == 36)
        .withColumn("start_time", F.date_format("start_time", stamp))
        .withColumn("end_time", F.date_format("end_time", stamp))
        .withColumn("duration_us", F.round(F.col("duration_seconds") * 1e6).cast("bigint"))
        .drop("run_id", "duration_seconds")
    )


def compacted_state(spark, sf_dir):
    """State of units made of events by user, appended in four parts with two compactions between."""
    events = table(spark, sf_dir, "events")
    states = state.StateTable(spark, storage.scratch_dir(spark))
    for part in range(4):
        some = events.where(F.pmod("event_id", F.lit(4)) == part).groupBy(
            F.col("user_id").cast("string").alias("unit_key")
        ).agg(F.count(F.lit(1)).alias("row_count"))
        states.append("events", "2024-01-31", some, f"part{part}")
        if part in (0, 2):
            states.compact("events", "2024-01-31")
    return states.latest("events", "2024-01-31").drop("seq")


def audit_retry(spark, sf_dir):
    """Run rows recorded in part, then all of them twice, as after failures half known: rows and
    distinct runs for each date and status."""
    path = storage.scratch_dir(spark)
    log = audit.AuditLog([audit.file_sink(spark, path)])
    runs = storage.materialise(_runs(spark, sf_dir), "runs")
    log.record(runs.where("status = 'success'"))
    for _ in range(2):
        log.record(runs)
    return log.read().groupBy("processing_date", "status").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("run_id").alias("run_count")
    )


def audit_history(spark, sf_dir):
    return audit.run_history(_runs(spark, sf_dir))


def audit_jsonl_lookup(spark, sf_dir):
    """Successes found in JSON lines among which some cannot be read."""
    runs = _runs(spark, sf_dir)
    line = F.to_json(F.struct(*runs.columns))
    broken = F.when(F.col("status") == "dq_mismatch", F.substring(line, 1, 40)).otherwise(line)
    path = storage.scratch_dir(spark) + "/audit"
    runs.select(broken.alias("value")).write.text(path)
    history = audit.file_sink(spark, path).read()
    return history.where(F.col("status") == "success").select("job_name", "processing_date")


def already_succeeded(spark, sf_dir):
    """Of all jobs and days, those the audit history lets a scheduler skip."""
    days = F.expr("explode(transform(sequence(DATE '2024-01-01', DATE '2024-02-02'), d -> string(d)))")
    wanted = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("job_"), "s_suppkey").alias("job_name"), days.alias("processing_date")
    )
    # Most were never run; some are asked for twice.
    wanted = wanted.unionByName(wanted.where(F.col("processing_date").endswith("5")))
    return audit.already_succeeded(wanted, _runs(spark, sf_dir))


def run_summary(spark, sf_dir):
    return audit.run_summary(_runs(spark, sf_dir))


def alert_rows(spark, sf_dir):
    return audit.alert_rows(_runs(spark, sf_dir)).drop("run_id")


def lineage_rows(spark, sf_dir):
    """Lineage events; the JSON is taken apart again to compare it."""
    rows = audit.lineage_rows(_runs(spark, sf_dir))
    return rows.select(
        "job_name", "event_type", "input_name", "output_name",
        F.get_json_object("event", "$.eventType").alias("json_type"),
        F.get_json_object("event", "$.outputs[0].name").alias("json_output"),
        F.length(F.get_json_object("event", "$.run.facets.errorMessage.message")).alias("error_length"),
    )


def latest_unit_state(spark, sf_dir):
    """The last event of every user and type, in order of time and id."""
    events = table(spark, sf_dir, "events")
    last = state.latest_state(
        events.select("user_id", "event_type", "ts", "event_id", "value"),
        key=("user_id", "event_type"), order=("ts", "event_id"),
    )
    return last.select("user_id", "event_type", "event_id", "value")


def unit_state_lines(spark, sf_dir):
    """Unit events kept as JSON lines, some broken, some without a key: the last state per unit."""
    events = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "purchase", state.WRITTEN).otherwise("exported")
    key = F.when(F.col("event_type") != "signup", F.concat(F.lit("lt1:"), "user_id"))
    rows = events.select(
        F.lit("orders").alias("job_name"),
        F.date_format("ts", "yyyy-MM-dd").alias("processing_date"),
        F.col("event_id").alias("seq"),
        key.alias("unit_key"),
        status.alias("status"),
        F.col("event_id").alias("records_read"),
        F.lit(0).alias("records_failed"),
        "event_type",
    )
    line = F.to_json(F.struct(*[c for c in rows.columns if c != "event_type"]))
    text = F.when(F.col("event_type") == "error", F.substring(line, 1, 30)).otherwise(line)
    path = storage.scratch_dir(spark) + "/state"
    rows.select(text.alias("value")).write.text(path)
    stored = state.StateTable(spark, path).events()
    return state.latest_state(stored).select(
        "processing_date", "unit_key", "status", "records_read", "records_failed"
    )


QUERIES = {
    "audit_append": audit_append,
    "audit_retry": audit_retry,
    "compacted_state": compacted_state,
    "audit_history": audit_history,
    "audit_jsonl_lookup": audit_jsonl_lookup,
    "already_succeeded": already_succeeded,
    "run_summary": run_summary,
    "alert_rows": alert_rows,
    "lineage_rows": lineage_rows,
    "latest_unit_state": latest_unit_state,
    "unit_state_lines": unit_state_lines,
}

_RUNS = """
WITH grouped AS (
  SELECT user_id, strftime(ts, '%Y-%m-%d') AS processing_date, count(*) AS source_row_count,
         count(*) FILTER (WHERE event_type <> 'error') AS target_row_count, max(event_id) AS last_event,
         min(ts) AS start_time, max(ts) AS end_time
  FROM events GROUP BY ALL
), runs AS (
  SELECT 'job_' || user_id AS job_name, processing_date, 'stage' AS source_schema,
         'ld_' || user_id AS source_table, 'wh' AS target_schema,
         't_' || (user_id % 20) AS target_table, source_row_count, target_row_count,
         CASE WHEN target_row_count = source_row_count THEN 'success'
              WHEN target_row_count = 0 THEN 'failed' ELSE 'dq_mismatch' END AS status,
         'spark' AS loader, source_row_count AS reported_count,
         CASE WHEN target_row_count = 0
              THEN 'all rows refused ' || repeat('event ' || last_event || ' ', 20) END AS error_detail, start_time, end_time
  FROM grouped
)"""

ORACLES = {
    "audit_append": _RUNS + """
SELECT * REPLACE (strftime(start_time, '%Y-%m-%d %H:%M:%S.%f') AS start_time,
                  strftime(end_time, '%Y-%m-%d %H:%M:%S.%f') AS end_time),
       true AS has_run_id, epoch_us(end_time) - epoch_us(start_time) AS duration_us
FROM runs""",
    "compacted_state": """
SELECT CAST(user_id AS VARCHAR) AS unit_key, 'part' || max(event_id % 4) AS status,
       max_by(n, event_id % 4) AS records_read, 0::BIGINT AS records_failed
FROM (SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id, event_id % 4) AS n FROM events)
GROUP BY user_id""",
    "audit_retry": _RUNS + """
SELECT processing_date, status, count(*) AS row_count, count(*) AS run_count FROM runs GROUP BY ALL""",
    "audit_history": _RUNS + """
SELECT target_table, count(*) AS total_runs,
       count(*) FILTER (WHERE status = 'dq_mismatch') AS mismatch_count,
       max(processing_date) AS last_date
FROM runs GROUP BY target_table""",
    "audit_jsonl_lookup": _RUNS + """
SELECT job_name, processing_date FROM runs WHERE status = 'success'""",
    "already_succeeded": _RUNS + """
, wanted AS (
  SELECT 'job_' || s_suppkey AS job_name, strftime(day, '%Y-%m-%d') AS processing_date
  FROM supplier, (SELECT unnest(range(DATE '2024-01-01', DATE '2024-02-03', INTERVAL 1 DAY)) AS day)
)
SELECT job_name, processing_date
FROM (SELECT * FROM wanted UNION ALL SELECT * FROM wanted WHERE processing_date LIKE '%5') r
WHERE EXISTS (SELECT 1 FROM runs d WHERE d.job_name = r.job_name
              AND d.processing_date = r.processing_date AND d.status = 'success')""",
    "run_summary": _RUNS + """
SELECT status, count(*) AS run_count, count(*) FILTER (WHERE status <> 'success') AS failure_count
FROM runs GROUP BY status""",
    "alert_rows": _RUNS + """
SELECT job_name, processing_date, status,
       upper(status) || ': ' || job_name || '/' || processing_date || ' (source=' || source_row_count
         || ' target=' || target_row_count || ')'
         || coalesce(' - ' || substr(error_detail, 1, 100), '') AS message
FROM runs WHERE status <> 'success'""",
    "lineage_rows": _RUNS + """
SELECT job_name, CASE WHEN status = 'success' THEN 'COMPLETE' ELSE 'FAIL' END AS event_type,
       source_schema || '.' || source_table AS input_name,
       target_schema || '.' || target_table AS output_name,
       CASE WHEN status = 'success' THEN 'COMPLETE' ELSE 'FAIL' END AS json_type,
       target_schema || '.' || target_table AS json_output,
       CAST(length(error_detail) AS INTEGER) AS error_length
FROM runs""",
    "latest_unit_state": """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n
  FROM events) WHERE n = 1""",
    "unit_state_lines": """
SELECT processing_date, unit_key, status, records_read, CAST(0 AS BIGINT) AS records_failed FROM (
  SELECT strftime(ts, '%Y-%m-%d') AS processing_date, 'lt1:' || user_id AS unit_key,
         CASE WHEN event_type = 'purchase' THEN 'written' ELSE 'exported' END AS status,
         event_id AS records_read,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) AS n
  FROM events WHERE event_type NOT IN ('signup', 'error')) WHERE n = 1""",
}
