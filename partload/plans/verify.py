"""Reconciling source and target."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from partload import jobs
from partload.operators import loading, reconcile, retention, units
from partload.operators.audit import AuditLog, file_sink
from partload.operators.state import WRITTEN, StateTable
from partload.plans.inputs import (
    DATE,
    MONTH,
    MONTH_TEXT_SQL,
    order_tables,
    orders_job,
    table,
)
from partload.sources import catalog, storage
from partload.spec import ErrorLimit, PartitionColumn, RunSetting

EXPIRY_DAY = dt.date(2024, 1, 31)


def _target(spark, job, tables):
    return jobs.target_frame(spark, job, tables).where(F.col("processing_date") == DATE)


def reconcile_total(spark, sf_dir):
    """A full load counted on both sides."""
    job, tables = orders_job(spark), order_tables(spark, sf_dir)
    jobs.load(job, tables, DATE)
    source = reconcile.source_counts(tables, [MONTH])
    return reconcile.verdict(
        source, _target(spark, job, tables).agg(F.count(F.lit(1)).alias("row_count"))
    )


def reconcile_partitions(spark, sf_dir):
    """The verdict of every partition."""
    job, tables = orders_job(spark), order_tables(spark, sf_dir)
    jobs.load(job, tables, DATE)
    return reconcile.partition_verdicts(
        reconcile.source_counts(tables, [MONTH]).groupBy(MONTH).agg(F.sum("row_count").alias("row_count")),
        reconcile.partition_counts(_target(spark, job, tables), [MONTH]),
        [MONTH],
    )


def reconcile_scoped(spark, sf_dir):
    """A load of the months since 1998; the source is counted for those months only."""
    job, tables = orders_job(spark), order_tables(spark, sf_dir)
    planned = storage.materialise(
        jobs.plan(job, tables, DATE).where(F.col(MONTH) >= "199801"), "units"
    )
    jobs.load(job, tables, DATE, planned)
    return reconcile.verdict(
        reconcile.source_counts(tables, [MONTH], planned),
        reconcile.partition_counts(_target(spark, job, tables), [MONTH]),
    )


def reconcile_mismatch(spark, sf_dir):
    """Verdicts per partition of a target that lost its urgent orders of one status."""
    job, tables = orders_job(spark), order_tables(spark, sf_dir)
    lost = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    jobs.load(job, {t: df.where(~lost) for t, df in tables.items()}, DATE)
    return reconcile.partition_verdicts(
        reconcile.source_counts(tables, [MONTH]),
        reconcile.partition_counts(_target(spark, job, tables), [MONTH]),
        [MONTH],
    )


def multi_source_count(spark, sf_dir):
    """Rows per load table summed to one source count."""
    counts = units.unit_counts(order_tables(spark, sf_dir), [])
    return counts.agg(
        F.sum("row_count").alias("source_count"), F.count(F.lit(1)).alias("table_count")
    )


def reported_vs_recounted(spark, sf_dir):
    """Rows the writer saw beside the rows found afterwards."""
    job, tables = orders_job(spark), order_tables(spark, sf_dir)
    result = jobs.load(job, tables, DATE)
    recounted = F.count(F.lit(1))
    return _target(spark, job, tables).agg(
        F.lit(result.reported).cast("bigint").alias("reported"),
        F.lit(result.by_table["lt1"]).cast("bigint").alias("reported_lt1"),
        F.lit(result.by_table["lt2"]).cast("bigint").alias("reported_lt2"),
        recounted.alias("recounted"),
        (F.lit(result.reported).cast("bigint") - recounted).alias("difference"),
    )


def replace_date(spark, sf_dir):
    """A rerun after values vanished from the source, without and with clearing the whole date, and
    a run after all of them vanished."""
    job, tables = orders_job(spark), order_tables(spark, sf_dir)
    later = {t: df.where(F.col(MONTH) >= 199601) for t, df in tables.items()}
    emptied = {t: df.where("o_orderkey < 0") for t, df in tables.items()}

    def verdict(name, some):
        return storage.materialise(
            reconcile.verdict(
                reconcile.source_counts(some, [MONTH]),
                reconcile.partition_counts(_target(spark, job, tables), [MONTH]),
            ).withColumn("rerun", F.lit(name)),
            "verdict",
        )

    out = None
    for name, whole in (("kept", False), ("replaced", True)):
        jobs.load(job, tables, DATE)
        jobs.load(job, later, DATE, whole_date=whole)
        row = verdict(name, later)
        out = row if out is None else out.unionByName(row)
    audit = AuditLog([file_sink(spark, f"{storage.scratch_dir(spark)}/audit")])
    jobs.run(spark, replace(job, replace_date=True), DATE, audit, tables=emptied)
    return out.unionByName(verdict("emptied", emptied))


def resume_text_keys(spark, sf_dir):
    """Lineitem by two text columns whose values coincide once joined by `_`: the first part is
    written, then a run resumes with the rest."""
    first, second = F.col("l_returnflag"), F.col("l_linestatus")
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(second == "O", F.concat(first, F.lit("_x"))).otherwise(first).alias("left_key"),
        F.when(second == "O", F.lit("y")).otherwise(F.lit("x_y")).alias("right_key"),
    )
    base = orders_job(spark)
    job = replace(
        base,
        source=replace(base.source, load_tables=("lineitem",), columns=tuple(lineitem.columns)),
        target=replace(
            base.target,
            partitions=(PartitionColumn("left_key", True), PartitionColumn("right_key", True)),
        ),
    )
    tables = {"lineitem": lineitem}
    folder = storage.scratch_dir(spark)
    audit = AuditLog([file_sink(spark, f"{folder}/audit")])
    state = StateTable(spark, f"{folder}/state")
    planned = storage.materialise(jobs.plan(job, tables, DATE), "units")
    jobs.load(
        job, tables, DATE, storage.materialise(planned.where("right_key = 'y'"), "first"),
        after_batch=lambda done: state.append(job.table_name, DATE, done, WRITTEN),
    )
    jobs.run(spark, job, DATE, audit, state, tables)
    row = audit.read().first()
    return _target(spark, job, tables).groupBy("left_key", "right_key").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(row.status).alias("status"),
        F.lit(row.reported_count).cast("bigint").alias("reported_count"),
    )


def load_with_bad_rows(spark, sf_dir):
    """Orders whose price is no number for one status, with an error limit above and one below
    the number of such rows: outcome, both counts and the rows left out."""
    tables = order_tables(spark, sf_dir)
    price = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    tables["lt1"] = tables["lt1"].withColumn("o_totalprice", price)
    bad = tables["lt1"].where("o_totalprice = 'n/a'").count()
    out = None
    for name, limit in (("above", bad), ("below", bad - 1)):
        job = orders_job(spark, setting=RunSetting(error_limit=ErrorLimit(record=limit)))
        folder = storage.scratch_dir(spark)
        audit = AuditLog([file_sink(spark, f"{folder}/audit")])
        jobs.run_all(spark, [job], DATE, audit, StateTable(spark, f"{folder}/state"), {job.table_name: tables})
        row = audit.read().select(
            F.lit(name).alias("error_limit"), "status", "source_row_count", "target_row_count",
            F.regexp_extract("error_detail", "([0-9]+) (of|rows)", 1).cast("bigint").alias("failed_rows"),
        )
        row = storage.materialise(row, "outcome")
        out = row if out is None else out.unionByName(row)
    return out


def footer_recount(spark, sf_dir):
    """The orders of one year counted by partition from the footers of the target's files."""
    job, tables = orders_job(spark), order_tables(spark, sf_dir)
    jobs.load(job, tables, DATE)
    schema = loading.target_schema(jobs.resolve(job, tables), [MONTH])
    where = f"processing_date = '{DATE}' AND {MONTH} LIKE '1996%'"
    return loading.footer_counts(
        spark, job.target.location, "parquet", schema, ["processing_date", MONTH], where
    )


def limit_keeps_old_rows(spark, sf_dir):
    """Orders loaded, then loaded again with changed keys and unfit prices of one status, which is above
    the error limit: what a target by month, a target of whole dates and one loaded in groups hold."""
    tables = order_tables(spark, sf_dir)
    price = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string"))
    later = {t: df.withColumn("o_orderkey", -F.col("o_orderkey")) for t, df in tables.items()}
    later["lt1"] = later["lt1"].withColumn("o_totalprice", price)
    out = None
    for name in ("by_month", "whole_date", "in_groups"):
        job = orders_job(spark, setting=RunSetting(values_per_batch=40 if name == "in_groups" else None))
        if name == "whole_date":
            job = replace(job, target=replace(job.target, partitions=()))
        audit = AuditLog([file_sink(spark, f"{storage.scratch_dir(spark)}/audit")])
        for given in (tables, later):
            jobs.run_all(spark, [job], DATE, audit, tables={job.table_name: given}, force=True)
        failed = audit.read().agg(F.count_if(F.col("status") == "failed")).first()[0]
        row = jobs.target_frame(spark, job, tables).select(
            F.lit(name).alias("target"), F.lit(failed).cast("bigint").alias("failed_runs"),
            "o_orderkey", "o_totalprice", F.col(MONTH).cast("string").alias(MONTH),
        )
        out = row if out is None else out.unionByName(row)
    return out


def expire_registered(spark, sf_dir):
    """Events of a registered table by day: dates, rows and registered partitions left after the old
    ones expired, and after a run whose metadata step fails."""
    events = table(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    base, out = orders_job(spark), None
    for name in ("expired", "metadata_failed"):
        job = replace(
            base,
            retention_days=10,
            source=replace(base.source, load_tables=("events",), columns=("event_id", "value")),
            target=replace(
                base.target, table=f"events_{uuid.uuid4().hex[:12]}", base_dir=f"events_{name}", partitions=()
            ),
        )
        written = events.select("event_id", "value", F.col("day").alias("processing_date"))
        loading.write_target(loading.arrange(written, ["processing_date"]), job.target.location)
        jobs.create_target(spark, job, {"events": events})
        full_name = job.target.full_name
        try:
            catalog.repair_table(spark, full_name)
            if name == "expired":
                _, summary = jobs.expire(spark, job, EXPIRY_DAY, dry_run=False)
            else:
                listed = storage.list_dated_partitions(spark, job.target.location)
                planned = retention.retention_plan(listed, EXPIRY_DAY, job.retention_days)
                done = retention.apply_retention(spark, planned, "no_such_table", dry_run=False)
                summary = retention.retention_summary(
                    planned.join(done.select("partition_date", "error"), "partition_date", "left")
                )
            schema = spark.table(catalog.ident(full_name)).schema
            left = loading.read_target(spark, job.target.location, "parquet", schema).agg(
                F.count(F.lit(1)).alias("rows_left"), F.countDistinct("processing_date").alias("dates_left")
            ).first()
            row = summary.select(
                F.lit(name).alias("run"), "kept_count", "expired_count", "had_errors",
                F.lit(left.rows_left).cast("bigint").alias("rows_left"),
                F.lit(left.dates_left).cast("bigint").alias("dates_left"),
                F.lit(catalog.show_partitions(spark, full_name).count()).cast("bigint").alias("registered"),
            )
            row = storage.materialise(row, "expired")
        finally:
            catalog.drop_table(spark, full_name)
        out = row if out is None else out.unionByName(row)
    return out


def run_jobs(spark, sf_dir):
    """Three jobs run end to end, then again: the second round is skipped by the audit history."""
    return _run_jobs(spark, sf_dir, 1)


def run_jobs_at_once(spark, sf_dir):
    """The same jobs side by side."""
    return _run_jobs(spark, sf_dir, 4)


def _run_jobs(spark, sf_dir, at_once):
    base = orders_job(spark)
    lineitem, customer = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "customer")
    flags = ("l_returnflag", "l_linestatus")

    def single(name, df, dynamic):
        return replace(
            base,
            table_name=name,
            source=replace(base.source, load_tables=(name,), columns=tuple(df.columns)),
            target=replace(
                base.target, table=f"{name}_target", base_dir=name,
                partitions=tuple(PartitionColumn(c, True) for c in dynamic),
            ),
        )

    all_jobs = [base, single("lineitem", lineitem, flags), single("customer", customer, ())]
    tables = {
        "orders": order_tables(spark, sf_dir),
        "lineitem": {"lineitem": lineitem},
        "customer": {"customer": customer},
    }
    folder = storage.scratch_dir(spark)
    audit = AuditLog([file_sink(spark, f"{folder}/audit")])
    state = StateTable(spark, f"{folder}/state")
    jobs.run_all(spark, all_jobs, DATE, audit, state, tables, at_once=at_once)
    again = jobs.run_all(spark, all_jobs, DATE, audit, state, tables, at_once=at_once)
    history = audit.read().select(
        "job_name", "source_row_count", "target_row_count", "reported_count", "status"
    )
    return history.join(
        again.select("job_name", F.col("outcome").alias("second_outcome")), "job_name"
    )


def incremental_run(spark, sf_dir):
    """A run after the months before 1998 were already written: they are kept, the rest is loaded."""
    job, tables = orders_job(spark), order_tables(spark, sf_dir)
    folder = storage.scratch_dir(spark)
    audit = AuditLog([file_sink(spark, f"{folder}/audit", "parquet")])
    state = StateTable(spark, f"{folder}/state")
    planned = storage.materialise(jobs.plan(job, tables, DATE), "units")
    first = planned.where(F.col(MONTH) < "199801")
    jobs.load(
        job, tables, DATE, first,
        after_batch=lambda done: state.append(job.table_name, DATE, done, WRITTEN),
    )
    files = F.col("_metadata.file_path")
    before = storage.materialise(_target(spark, job, tables).select(files.alias("path")).distinct(), "files")
    jobs.run(spark, job, DATE, audit, state, tables)
    after = _target(spark, job, tables).groupBy(MONTH, files.alias("path")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    kept = before.withColumn("kept", F.lit(True))
    per_month = after.join(kept, "path", "left").groupBy(MONTH).agg(
        F.sum("row_count").alias("row_count"), F.bool_and(F.coalesce("kept", F.lit(False))).alias("kept")
    )
    row = audit.read().select("reported_count", "status").first()
    return per_month.withColumn("reported_count", F.lit(row.reported_count).cast("bigint")).withColumn(
        "status", F.lit(row.status)
    )


def expire_job(spark, sf_dir):
    """Orders loaded for three dates; retention then expires by a cutoff."""
    job, tables = orders_job(spark, retention_days=10), order_tables(spark, sf_dir)
    for day in ("2024-01-11", "2024-01-21", "2024-01-31"):
        jobs.load(job, tables, day)
    jobs.expire(spark, job, dt.date(2024, 1, 31), dry_run=False)
    return reconcile.partition_counts(jobs.target_frame(spark, job, tables), ["processing_date"])


QUERIES = {
    "reconcile_total": reconcile_total,
    "reconcile_partitions": reconcile_partitions,
    "reconcile_scoped": reconcile_scoped,
    "reconcile_mismatch": reconcile_mismatch,
    "multi_source_count": multi_source_count,
    "reported_vs_recounted": reported_vs_recounted,
    "replace_date": replace_date,
    "run_jobs": run_jobs,
    "run_jobs_at_once": run_jobs_at_once,
    "incremental_run": incremental_run,
    "expire_job": expire_job,
    "resume_text_keys": resume_text_keys,
    "load_with_bad_rows": load_with_bad_rows,
    "limit_keeps_old_rows": limit_keeps_old_rows,
    "footer_recount": footer_recount,
    "expire_registered": expire_registered,
}

_JOB_ROW = """
SELECT '{name}' AS job_name, count(*) AS source_row_count, count(*) AS target_row_count,
       count(*) AS reported_count, 'success' AS status, 'skipped' AS second_outcome
FROM {name}"""

ORACLES = {
    "reconcile_total": """
SELECT count(*) AS source_count, count(*) AS target_count, 'success' AS status FROM orders""",
    "reconcile_partitions": f"""
SELECT {MONTH_TEXT_SQL} AS order_month, count(*) AS source_count, count(*) AS target_count,
       'success' AS status
FROM orders GROUP BY ALL""",
    "reconcile_scoped": """
SELECT count(*) AS source_count, count(*) AS target_count, 'success' AS status
FROM orders WHERE year(o_orderdate) >= 1998""",
    "reconcile_mismatch": f"""
WITH counted AS (
  SELECT {MONTH_TEXT_SQL} AS order_month, count(*) AS source_count,
         count(*) FILTER (WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'))
           AS target_count
  FROM orders GROUP BY ALL
)
SELECT *, CASE WHEN source_count = target_count THEN 'success' ELSE 'dq_mismatch' END AS status
FROM counted""",
    "multi_source_count": """
SELECT count(*) AS source_count, CAST(2 AS BIGINT) AS table_count FROM orders""",
    "reported_vs_recounted": """
SELECT count(*) AS reported, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS reported_lt1,
       count(*) FILTER (WHERE o_orderkey % 2 = 1) AS reported_lt2, count(*) AS recounted,
       CAST(0 AS BIGINT) AS difference
FROM orders""",
    "replace_date": """
WITH counted AS (
  SELECT count(*) AS everything, count(*) FILTER (WHERE year(o_orderdate) >= 1996) AS later FROM orders
)
SELECT later AS source_count, CASE rerun WHEN 'kept' THEN everything ELSE later END AS target_count,
       CASE WHEN rerun = 'kept' AND later < everything THEN 'dq_mismatch' ELSE 'success' END AS status,
       rerun
FROM counted, (VALUES ('kept'), ('replaced')) v(rerun)
UNION ALL SELECT 0, 0, 'success', 'emptied'""",
    "resume_text_keys": """
SELECT CASE l_linestatus WHEN 'O' THEN l_returnflag || '_x' ELSE l_returnflag END AS left_key,
       CASE l_linestatus WHEN 'O' THEN 'y' ELSE 'x_y' END AS right_key,
       count(*) AS row_count, 'success' AS status,
       (SELECT count(*) FROM lineitem) AS reported_count
FROM lineitem GROUP BY ALL""",
    "footer_recount": f"""
SELECT '{DATE}' AS processing_date, {MONTH_TEXT_SQL} AS order_month, count(*) AS row_count
FROM orders WHERE year(o_orderdate) = 1996 GROUP BY ALL""",
    "limit_keeps_old_rows": f"""
SELECT t.target, 1::BIGINT AS failed_runs, o_orderkey, o_totalprice, {MONTH_TEXT_SQL} AS order_month
FROM orders, (SELECT unnest(['by_month', 'whole_date', 'in_groups']) AS target) AS t""",
    "load_with_bad_rows": """
WITH counted AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 2 = 0 AND o_orderstatus = 'P') AS bad FROM orders
)
SELECT 'above' AS error_limit, 'dq_mismatch' AS status, n AS source_row_count,
       n - bad AS target_row_count, bad AS failed_rows FROM counted
UNION ALL SELECT 'below', 'failed', NULL, NULL, bad FROM counted""",
    "expire_registered": f"""
WITH days AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
s AS (
  SELECT count(*) FILTER (WHERE day > DATE '{EXPIRY_DAY}' - 10) AS kept_count,
         count(*) FILTER (WHERE day <= DATE '{EXPIRY_DAY}' - 10) AS expired_count,
         CAST(sum(n) FILTER (WHERE day > DATE '{EXPIRY_DAY}' - 10) AS BIGINT) AS rows_left, count(*) AS every
  FROM days
)
SELECT run, kept_count, expired_count, run = 'metadata_failed' AS had_errors, rows_left,
       kept_count AS dates_left, CASE run WHEN 'expired' THEN kept_count ELSE every END AS registered
FROM s, (VALUES ('expired'), ('metadata_failed')) v(run)""",
    "run_jobs": " UNION ALL ".join(
        _JOB_ROW.format(name=n) for n in ("orders", "lineitem", "customer")
    ),
    "run_jobs_at_once": " UNION ALL ".join(
        _JOB_ROW.format(name=n) for n in ("orders", "lineitem", "customer")
    ),
    "incremental_run": f"""
SELECT {MONTH_TEXT_SQL} AS order_month, count(*) AS row_count, year(o_orderdate) < 1998 AS kept,
       (SELECT count(*) FROM orders) AS reported_count, 'success' AS status
FROM orders GROUP BY ALL""",
    "expire_job": """
SELECT processing_date, count(*) AS row_count
FROM orders, (VALUES ('2024-01-31')) v(processing_date) GROUP BY processing_date""",
}
