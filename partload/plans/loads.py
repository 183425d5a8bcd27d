"""Planning, loading and registering."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from partload import jobs
from partload.functions import keys
from partload.operators import loading, schema, units
from partload.operators.state import WRITTEN, latest_state, paths_to_clear, pending_units, reused_units
from partload.plans.inputs import (
    DATE,
    LOAD_TABLE_SQL,
    MONTH,
    MONTH_SQL,
    MONTH_TEXT_SQL,
    month,
    order_tables,
    orders_job,
    table,
)
from partload.sources import catalog, storage
from partload.spec import PartitionColumn, RunSetting


def _read(spark, job, tables):
    return jobs.target_frame(spark, job, tables)


def plan_units(spark, sf_dir):
    """Units of both load tables with their keys, filters, specs and paths."""
    job = orders_job(spark)
    planned = jobs.plan(
        replace(job, target=replace(job.target, root="", base_dir="/Warehouse.DB/Orders")),
        order_tables(spark, sf_dir), DATE,
    )
    return planned.select(
        "load_table", "where_clause", "file_label", "unit_key", "target_path", "row_count",
        keys.partition_spec_text(F.col("partition_values")).alias("partition_spec"),
    )


def unit_row_counts(spark, sf_dir):
    counts = units.unit_counts(order_tables(spark, sf_dir), [MONTH])
    return counts.select("load_table", MONTH, "row_count")


def target_partitions(spark, sf_dir):
    """Distinct target partitions over all load tables."""
    planned = jobs.plan(orders_job(spark), order_tables(spark, sf_dir), DATE)
    return units.target_partitions(planned).select("partition_spec", "row_count")


def partitioned_load(spark, sf_dir):
    """The orders job loaded and read back: rows and key sum per partition."""
    job, tables = orders_job(spark), order_tables(spark, sf_dir)
    jobs.load(job, tables, DATE)
    return _read(spark, job, tables).groupBy("processing_date", MONTH).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum")
    )


def multi_source_load(spark, sf_dir):
    """Two load tables of different types in one target; every row is read back in full."""
    job, tables = orders_job(spark), order_tables(spark, sf_dir, mixed_types=True)
    jobs.load(job, tables, DATE)
    return _read(spark, job, tables).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority", MONTH,
    )


def preserve_types_load(spark, sf_dir):
    """The same load keeping decimal and timestamp columns in their own types."""
    job = orders_job(spark, preserve_types=True)
    tables = order_tables(spark, sf_dir)
    tables = {
        t: df.withColumn("o_totalprice", F.col("o_totalprice").cast(f"decimal({p},{s})"))
        for (t, df), (p, s) in zip(tables.items(), ((12, 2), (14, 3)))
    }
    jobs.load(job, tables, DATE)
    back = _read(spark, job, tables)
    return back.groupBy(MONTH).agg(
        F.sum("o_totalprice").cast("decimal(38,3)").cast("string").alias("price_sum"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("last_date"),
    )


def idempotent_rerun(spark, sf_dir):
    """A full load, then every partition of the latest year loaded again one by one."""
    job, tables = orders_job(spark), order_tables(spark, sf_dir)
    jobs.load(job, tables, DATE)
    again = replace(job, setting=RunSetting(values_per_batch=3))
    planned = storage.materialise(jobs.plan(job, tables, DATE), "units")
    last = planned.agg(F.max(F.substring(MONTH, 1, 4))).first()[0]
    jobs.load(again, tables, DATE, planned.where(F.col(MONTH).startswith(last)))
    month = planned.agg(F.min(MONTH)).first()[0]
    for _ in range(2):
        jobs.load_one(job, tables, DATE, {MONTH: month})
    return _read(spark, job, tables).groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("o_orderkey").alias("key_count")
    )


def pruned_resume(spark, sf_dir):
    """Orders stored by month; all months but those of the latest year are finished, so the resumed load
    reads the files of that year alone."""
    folder = f"{storage.scratch_dir(spark)}/orders"
    orders = table(spark, sf_dir, "orders").withColumn(MONTH, month())
    orders.repartition(MONTH).write.partitionBy(MONTH).parquet(folder)
    job = orders_job(spark)
    job = replace(job, source=replace(job.source, load_tables=("lt1",)))
    tables = {"lt1": spark.read.parquet(folder)}
    planned = storage.materialise(jobs.plan(job, tables, DATE), "units")
    last = planned.agg(F.max(F.substring(MONTH, 1, 4))).first()[0]
    jobs.load(job, tables, DATE, planned.where(F.col(MONTH).startswith(last)))
    return _read(spark, job, tables).groupBy("processing_date", MONTH).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum")
    )


def skewed_fanout_load(spark, sf_dir):
    """Lineitem by flag and status, few heavy values, each in exactly four files."""
    lineitem = table(spark, sf_dir, "lineitem")
    job = orders_job(spark, setting=RunSetting(files_per_partition=4))
    dynamic = ("l_returnflag", "l_linestatus")
    job = replace(
        job,
        source=replace(job.source, load_tables=("lineitem",), columns=tuple(lineitem.columns)),
        target=replace(job.target, partitions=tuple(PartitionColumn(c, True) for c in dynamic)),
    )
    tables = {"lineitem": lineitem}
    jobs.load(job, tables, DATE)
    return _read(spark, job, tables).groupBy(*dynamic).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("l_orderkey").alias("key_sum"),
        F.countDistinct("_metadata.file_path").alias("file_count"),
    )


def text_load(spark, sf_dir):
    """Documents loaded into a delimited-text target by language and read back."""
    documents = table(spark, sf_dir, "documents")
    job = orders_job(spark, setting=RunSetting(max_records_per_file=50_000))
    job = replace(
        job,
        source=replace(job.source, load_tables=("documents",), columns=tuple(documents.columns)),
        target=replace(job.target, file_format="text", partitions=(PartitionColumn("lang", True),)),
    )
    tables = {"documents": documents}
    jobs.load(job, tables, DATE)
    return _read(spark, job, tables).select(
        "doc_id", F.md5("text").alias("text_md5"), "source", "n_chars", "processing_date", "lang"
    )


def special_partition_values(spark, sf_dir):
    """Events by a text key holding NULL, '' and characters a path must escape."""
    events = table(spark, sf_dir, "events")
    kind = (
        F.when(F.col("event_type") == "click", F.lit("a/b=c d%"))
        .when(F.col("event_type") == "error", F.lit(None))
        .when(F.col("event_type") == "view", F.lit(""))
        .otherwise(F.col("event_type"))
    )
    job = orders_job(spark)
    job = replace(
        job,
        source=replace(job.source, load_tables=("events",), columns=("event_id", "value", "kind")),
        target=replace(job.target, partitions=(PartitionColumn("kind", True),)),
    )
    tables = {"events": events.select("event_id", "value", kind.alias("kind"))}
    jobs.load(job, tables, DATE)
    planned = jobs.plan(job, tables, DATE)
    wanted = planned.select(
        F.col("kind"), F.substring_index("target_path", "/", -1).alias("directory")
    )
    read = _read(spark, job, tables).groupBy("kind").agg(
        F.count(F.lit(1)).alias("row_count"), F.max("value").alias("max_value")
    )
    return wanted.join(read, wanted["kind"].eqNullSafe(read["kind"])).select(
        wanted["kind"], "directory", "row_count", "max_value"
    )


def _registered(spark, sf_dir, register):
    job, tables = orders_job(spark), order_tables(spark, sf_dir)
    job = replace(job, target=replace(job.target, table=f"orders_{uuid.uuid4().hex[:12]}"))
    jobs.load(job, tables, DATE)
    jobs.create_target(spark, job, tables)
    try:
        register(job, tables)
        shown = catalog.show_partitions(spark, job.target.full_name)
        counted = (
            _read(spark, job, tables)
            .groupBy(F.concat_ws("/", F.concat(F.lit("processing_date="), "processing_date"),
                                 F.concat(F.lit("order_month="), MONTH)).alias("partition"))
            .agg(F.count(F.lit(1)).alias("row_count"))
        )
        return storage.materialise(shown.join(counted, "partition", "left"), "partitions")
    finally:
        catalog.drop_table(spark, job.target.full_name)


def register_partitions(spark, sf_dir):
    """Partitions the catalog knows after explicit registration, with the rows a table read finds."""
    def register(job, tables):
        wanted = storage.materialise(jobs.plan(job, tables, DATE), "units")
        jobs.register(spark, job, DATE, wanted)

    return _registered(spark, sf_dir, register)


def repair_partitions(spark, sf_dir):
    """The same through directory discovery."""
    return _registered(
        spark, sf_dir, lambda job, _: catalog.repair_table(spark, job.target.full_name)
    )


def rows_per_unit_cap(spark, sf_dir):
    """Five rows per load table and month, in key order."""
    tables = order_tables(spark, sf_dir)
    job = orders_job(spark)
    frame = loading.load_frame(tables, jobs.resolve(job, tables), [MONTH], DATE)
    capped = units.first_rows(frame, [loading.ORDINAL, MONTH], ["o_orderkey"], 5)
    load_table = F.when(F.col(loading.ORDINAL) == 0, "lt1").otherwise("lt2")
    return capped.select(load_table.alias("load_table"), MONTH, "o_orderkey", "o_totalprice")


def proof_load(spark, sf_dir):
    """Three units of five rows each in a scratch table, recounted."""
    proof = jobs.proof_load(
        spark, orders_job(spark), order_tables(spark, sf_dir), DATE, row_limit=5, partition_limit=3
    )
    return proof.drop("location")


def _units_and_state(spark, sf_dir):
    """The orders plan, and unit events derived from the orders themselves.

    Every unit was exported; it was then written if finished orders outnumber open ones.
    """
    tables = order_tables(spark, sf_dir)
    planned = jobs.plan(orders_job(spark), tables, DATE)
    relative = F.substring_index("target_path", "/", -2)
    planned = planned.withColumn("target_path", relative)
    resolved = schema.unify({t: df.schema for t, df in tables.items()}, ["o_orderstatus"])
    frame = loading.load_frame(tables, resolved, [MONTH], DATE)
    label = F.when(F.col(loading.ORDINAL) == 0, "lt1:order_month=").otherwise("lt2:order_month=")
    counted = frame.groupBy(F.concat(label, MONTH).alias("unit_key")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("done"),
        F.count_if(F.col("o_orderstatus") == "O").alias("open"),
        F.count(F.lit(1)).alias("records_read"),
    )
    exported = counted.select("unit_key", F.lit(1).alias("seq"), F.lit("exported").alias("status"),
                              F.lit(0).cast("bigint").alias("records_read"))
    written = counted.where(F.col("done") > F.col("open")).select(
        "unit_key", F.lit(2).alias("seq"), F.lit(WRITTEN).alias("status"), "records_read"
    )
    events = exported.unionByName(written).withColumn("records_failed", F.lit(0).cast("bigint"))
    return planned, latest_state(events, ("unit_key",))


def resume_pending(spark, sf_dir):
    """Units still to load; a partition with one unwritten unit is loaded again as a whole."""
    planned, state = _units_and_state(spark, sf_dir)
    return pending_units(planned, state).select("unit_key", "target_path", "row_count")


def resume_reused(spark, sf_dir):
    """Units of finished partitions with their stored counts."""
    planned, state = _units_and_state(spark, sf_dir)
    reused = reused_units(planned, state, pending_units(planned, state))
    return reused.select("unit_key", "target_path", "records_read")


def paths_to_clear_(spark, sf_dir):
    """Target paths no written unit protects."""
    return paths_to_clear(*_units_and_state(spark, sf_dir))


QUERIES = {
    "plan_units": plan_units,
    "unit_row_counts": unit_row_counts,
    "target_partitions": target_partitions,
    "partitioned_load": partitioned_load,
    "multi_source_load": multi_source_load,
    "preserve_types_load": preserve_types_load,
    "idempotent_rerun": idempotent_rerun,
    "pruned_resume": pruned_resume,
    "skewed_fanout_load": skewed_fanout_load,
    "text_load": text_load,
    "special_partition_values": special_partition_values,
    "register_partitions": register_partitions,
    "repair_partitions": repair_partitions,
    "rows_per_unit_cap": rows_per_unit_cap,
    "proof_load": proof_load,
    "resume_pending": resume_pending,
    "resume_reused": resume_reused,
    "paths_to_clear": paths_to_clear_,
}

_UNITS = f"""
WITH units AS (
  SELECT {LOAD_TABLE_SQL} AS load_table, {MONTH_TEXT_SQL} AS order_month, count(*) AS row_count,
         count(*) FILTER (WHERE o_orderstatus = 'F') > count(*) FILTER (WHERE o_orderstatus = 'O')
           AS written
  FROM orders GROUP BY ALL
)"""
_REGISTERED = f"""
SELECT 'processing_date={DATE}/order_month=' || {MONTH_TEXT_SQL} AS partition, count(*) AS row_count
FROM orders GROUP BY ALL"""
_PATH = f"'processing_date={DATE}/order_month=' || order_month"

ORACLES = {
    "plan_units": _UNITS + f"""
SELECT load_table, 'order_month = ' || order_month AS where_clause, order_month AS file_label,
       load_table || ':order_month=' || order_month AS unit_key,
       '/warehouse.db/orders/' || {_PATH} AS target_path, row_count,
       'order_month="' || order_month || '"' AS partition_spec
FROM units""",
    "unit_row_counts": _UNITS + " SELECT load_table, order_month, row_count FROM units",
    "target_partitions": f"""
SELECT 'order_month="' || {MONTH_TEXT_SQL} || '"' AS partition_spec, count(*) AS row_count
FROM orders GROUP BY ALL""",
    "partitioned_load": f"""
SELECT '{DATE}' AS processing_date, {MONTH_TEXT_SQL} AS order_month, count(*) AS row_count,
       CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders GROUP BY ALL""",
    "pruned_resume": f"""
SELECT '{DATE}' AS processing_date, {MONTH_TEXT_SQL} AS order_month, count(*) AS row_count,
       CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY ALL""",
    "multi_source_load": f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 2 = 1 THEN CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE)
            ELSE o_totalprice END AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority,
       {MONTH_TEXT_SQL} AS order_month
FROM orders""",
    "preserve_types_load": f"""
SELECT {MONTH_TEXT_SQL} AS order_month,
       CAST(sum(CASE WHEN o_orderkey % 2 = 0
                     THEN CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DECIMAL(15, 3))
                     ELSE CAST(CAST(o_totalprice AS DECIMAL(14, 3)) AS DECIMAL(15, 3)) END)
            AS VARCHAR) AS price_sum,
       strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_date
FROM orders GROUP BY ALL""",
    "idempotent_rerun": f"""
SELECT {MONTH_TEXT_SQL} AS order_month, count(*) AS row_count,
       count(DISTINCT o_orderkey) AS key_count
FROM orders GROUP BY ALL""",
    "skewed_fanout_load": """
SELECT l_returnflag, l_linestatus, count(*) AS row_count,
       CAST(sum(l_orderkey) AS BIGINT) AS key_sum, 4::BIGINT AS file_count
FROM lineitem GROUP BY ALL""",
    "text_load": f"""
SELECT doc_id, md5(text) AS text_md5, nullif(source, '') AS source, n_chars,
       '{DATE}' AS processing_date, lang
FROM documents""",
    "special_partition_values": """
SELECT CASE event_type WHEN 'click' THEN 'a/b=c d%' WHEN 'error' THEN NULL WHEN 'view' THEN NULL
            ELSE event_type END AS kind,
       'kind=' || CASE event_type WHEN 'click' THEN 'a%2Fb%3Dc d%25'
            WHEN 'error' THEN '__HIVE_DEFAULT_PARTITION__'
            WHEN 'view' THEN '__HIVE_DEFAULT_PARTITION__' ELSE event_type END AS directory,
       count(*) AS row_count, max(value) AS max_value
FROM events GROUP BY ALL""",
    "register_partitions": _REGISTERED,
    "repair_partitions": _REGISTERED,
    "rows_per_unit_cap": f"""
SELECT load_table, order_month, o_orderkey, o_totalprice FROM (
  SELECT {LOAD_TABLE_SQL} AS load_table, {MONTH_TEXT_SQL} AS order_month, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY {LOAD_TABLE_SQL}, {MONTH_SQL} ORDER BY o_orderkey) AS n
  FROM orders) WHERE n <= 5""",
    "proof_load": _UNITS + """
SELECT CAST(sum(least(row_count, 5)) AS BIGINT) AS target_count,
       CAST(sum(least(row_count, 5)) AS BIGINT) AS reported_count, true AS passed
FROM (SELECT * FROM units ORDER BY load_table, order_month LIMIT 3)""",
    "resume_pending": _UNITS + f"""
SELECT load_table || ':order_month=' || order_month AS unit_key, {_PATH} AS target_path, row_count
FROM units u
WHERE EXISTS (SELECT 1 FROM units o WHERE o.order_month = u.order_month AND NOT o.written)""",
    "resume_reused": _UNITS + f"""
SELECT load_table || ':order_month=' || order_month AS unit_key, {_PATH} AS target_path,
       row_count AS records_read
FROM units u
WHERE NOT EXISTS (SELECT 1 FROM units o WHERE o.order_month = u.order_month AND NOT o.written)""",
    "paths_to_clear": _UNITS + f"""
SELECT {_PATH} AS target_path FROM units EXCEPT
SELECT {_PATH} AS target_path FROM units WHERE written""",
}
