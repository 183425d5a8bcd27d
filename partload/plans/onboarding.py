"""Migration risk, with suppliers as configured tables and their lineitems as run history."""

from __future__ import annotations

from pyspark.sql import functions as F

from partload.functions import text
from partload.operators import onboarding
from partload.plans.inputs import table
from partload.sources import rows


def _config(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    nation = F.col("s_nationkey")
    return supplier.select(
        "s_suppkey",
        F.col("s_name").alias("target_table"),
        F.when(F.col("s_acctbal") < 0, " tpt ").when(nation < 5, "").otherwise("write_nos").alias(
            "export_method"
        ),
        F.when(nation == 7, "y").alias("skip"),
        F.when(nation.between(10, 14), F.concat(F.lit("country=C"), nation, F.lit(", date_key ,")))
        .when(nation > 14, F.lit(" country = XX,, region=Y"))
        .alias("partitions"),
    )


def _rows(spark, sf_dir):
    config = _config(spark, sf_dir)
    lineitem = table(spark, sf_dir, "lineitem")
    mismatch = (F.col("l_discount") >= 0.1) & (F.col("l_tax") >= 0.08) & (F.col("l_quantity") >= 48)
    per_supplier = lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.count(F.lit(1)).alias("total_runs"),
        F.count_if(mismatch).alias("mismatch_count"),
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("last_date"),
    )
    history = per_supplier.join(config.select("s_suppkey", "target_table"), "s_suppkey").drop("s_suppkey")
    return onboarding.risk_rows(config, history)


def risk_rows(spark, sf_dir):
    """Every configured table with its bucket and reasons."""
    rows = _rows(spark, sf_dir)
    return rows.withColumn("reasons", F.array_join("reasons", "; "))


def risk_ranking(spark, sf_dir):
    """Tables at risk, most mismatches first."""
    return onboarding.rank_at_risk(_rows(spark, sf_dir)).select(
        "target_table", "mismatch_count", "total_runs", "last_date"
    )


def risk_buckets(spark, sf_dir):
    return onboarding.risk_buckets(_rows(spark, sf_dir))


def parse_partition_spec(spark, sf_dir):
    """Static and dynamic names of a partition list."""
    spec = F.col("partitions")
    return _config(spark, sf_dir).select(
        "target_table",
        F.array_join(text.static_partitions(spec), "|").alias("static_names"),
        F.array_join(text.dynamic_partitions(spec), "|").alias("dynamic_names"),
        text.has_dynamic_partition(spec).alias("has_dynamic"),
    )


def draft_jobs(spark, sf_dir):
    """One job draft over orders for each nation's configuration: what was read from it, and how the
    column list it declares compares to the real one."""
    orders = table(spark, sf_dir, "orders")
    sources = {name: orders.schema for name in ("orders", "orders_a", "orders_b")}
    real, found = orders.columns, []
    declared = {0: real, 1: real[::-1], 2: real[:-1], 3: []}
    for n in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect():
        config = {
            "target_table": n.n_name,
            "target_dir": f"/Lake/{n.n_name}",
            "columns": ", ".join(declared[n.n_nationkey % 4]),
            "partitions": "region = EU, o_orderpriority" if n.n_regionkey < 2 else None,
            "retention": str(n.n_nationkey) if n.n_nationkey > 9 else None,
        }
        if n.n_regionkey == 3:
            config |= {"load_owner": "stage", "load_tables": "orders_a;orders_b"}
        else:
            config |= {"source_owner": "core", "source_table": "orders"}
        job, verdict = onboarding.draft_job(config, sources)
        found.append((
            job["table_name"], job["source"]["owner"], ",".join(job["source"]["load_tables"]),
            len(job["source"]["columns"]), job["target"]["base_dir"],
            ",".join(p["column"] for p in job["target"]["partitions"]), job["retention_days"], verdict,
        ))
    return rows.few_rows(
        spark,
        "table_name string, owner string, load_tables string, column_count bigint, base_dir string, "
        "dynamic_columns string, retention_days int, verdict string",
        found,
    )


QUERIES = {
    "draft_jobs": draft_jobs,
    "risk_rows": risk_rows,
    "risk_ranking": risk_ranking,
    "risk_buckets": risk_buckets,
    "parse_partition_spec": parse_partition_spec,
}

_CONFIG = """
WITH config AS (
  SELECT s_suppkey, s_name AS target_table,
         CASE WHEN s_acctbal < 0 THEN 'TPT' ELSE 'WRITE_NOS' END AS export_method,
         CASE WHEN s_nationkey = 7 THEN 'Y' ELSE 'N' END AS skip,
         CASE WHEN s_nationkey BETWEEN 10 AND 14 THEN 'country=C' || s_nationkey || ', date_key ,'
              WHEN s_nationkey > 14 THEN ' country = XX,, region=Y' ELSE '' END AS partitions
  FROM supplier
), parts AS (
  SELECT s_suppkey, target_table,
         list_filter(list_transform(string_split(partitions, ','), lambda x: trim(x)),
                     lambda x: x <> '') AS p
  FROM config
), names AS (
  SELECT s_suppkey, target_table,
         array_to_string(list_transform(list_filter(p, lambda x: contains(x, '=')),
                         lambda x: trim(string_split(x, '=')[1])), '|') AS static_names,
         array_to_string(list_filter(p, lambda x: NOT contains(x, '=')), '|') AS dynamic_names,
         len(list_filter(p, lambda x: NOT contains(x, '='))) > 0 AS has_dynamic
  FROM parts
)"""
_RISK = _CONFIG + """, history AS (
  SELECT l_suppkey AS s_suppkey, count(*) AS total_runs,
         count(*) FILTER (WHERE l_discount >= 0.1 AND l_tax >= 0.08 AND l_quantity >= 48)
           AS mismatch_count,
         strftime(max(l_shipdate), '%Y-%m-%d') AS last_date
  FROM lineitem GROUP BY ALL
), joined AS (
  SELECT c.target_table, export_method, skip, partitions,
         coalesce(total_runs, 0) AS total_runs, coalesce(mismatch_count, 0) AS mismatch_count,
         last_date, has_dynamic AS has_dynamic_partition
  FROM config c JOIN names n USING (s_suppkey) LEFT JOIN history h USING (s_suppkey)
  WHERE skip <> 'Y'
), risk AS (
  SELECT *,
         CASE WHEN export_method = 'TPT' THEN 'migrated'
              WHEN mismatch_count > 0 OR has_dynamic_partition THEN 'at_risk' ELSE 'low_risk' END
           AS bucket,
         concat_ws('; ',
           CASE WHEN mismatch_count > 0
                THEN mismatch_count || ' of ' || total_runs || ' runs did not match' END,
           CASE WHEN has_dynamic_partition AND export_method <> 'TPT'
                THEN 'dynamic partition (' || partitions || ') on method ' || export_method END
         ) AS reasons
  FROM joined
)"""

ORACLES = {
    "draft_jobs": """
SELECT lower(n_name) AS table_name, CASE WHEN n_regionkey = 3 THEN 'stage' ELSE 'core' END AS owner,
       CASE WHEN n_regionkey = 3 THEN 'orders_a,orders_b' ELSE 'orders' END AS load_tables,
       (SELECT count(*) FROM (DESCRIBE orders)) AS column_count, '/lake/' || lower(n_name) AS base_dir,
       CASE WHEN n_regionkey < 2 THEN 'o_orderpriority' ELSE '' END AS dynamic_columns,
       CASE WHEN n_nationkey > 9 THEN n_nationkey::INTEGER END AS retention_days,
       CASE n_nationkey % 4 WHEN 0 THEN 'same' WHEN 1 THEN 'other_order' WHEN 2 THEN 'different_set'
            ELSE 'none' END AS verdict
FROM nation""",
    "risk_rows": _RISK + " SELECT * FROM risk",
    "risk_ranking": _RISK + """
SELECT target_table, mismatch_count, total_runs, last_date FROM risk WHERE bucket = 'at_risk'
ORDER BY mismatch_count DESC, target_table""",
    "risk_buckets": _RISK + " SELECT bucket, count(*) AS table_count FROM risk GROUP BY bucket",
    "parse_partition_spec": _CONFIG + """
SELECT target_table, static_names, dynamic_names, has_dynamic FROM names""",
}
