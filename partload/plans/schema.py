"""Types and column lists."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from partload.operators import schema as schemas
from partload.operators import units
from partload.plans.inputs import ORDER_COLUMNS, order_tables, table
from partload.sources import rows


def _declared(df, **lengths):
    """The frame with declared text types, as a catalog table has them."""
    return df.withColumns(
        {c: F.col(c).alias(c, metadata={"__CHAR_VARCHAR_TYPE_STRING": t}) for c, t in lengths.items()}
    )


def _declared_tables(spark, sf_dir):
    tables = order_tables(spark, sf_dir, mixed_types=True)
    first = _declared(tables["lt1"], o_orderstatus="varchar(3)", o_orderpriority="char(20)")
    return {"lt1": first, "lt2": _declared(tables["lt2"], o_orderstatus="varchar(7)", o_orderpriority="varchar(15)")}


def schema_resolve(spark, sf_dir):
    """Resolved type of every order column, and of one nobody has, over two load tables that declare
    them differently, beside the longest text and the number of values found."""
    tables = _declared_tables(spark, sf_dir)
    metadata = schemas.column_metadata(spark, {t: df.schema for t, df in tables.items()})
    asked = [(c,) for c in (*ORDER_COLUMNS, "o_shipmode")]
    resolved = schemas.resolve_metadata(metadata, rows.few_rows(spark, "column_name string", asked))
    orders = table(spark, sf_dir, "orders")
    measured = schemas.profile_columns(orders, [c for c in ORDER_COLUMNS if c in orders.columns])
    return resolved.join(measured, "column_name", "left")


def missing_columns(spark, sf_dir):
    """Columns asked of each load table that it does not have, by the number of its rows."""
    tables = order_tables(spark, sf_dir, mixed_types=True)
    tables = {"lt1": tables["lt1"].drop("o_custkey"), "lt2": tables["lt2"]}
    metadata = schemas.column_metadata(spark, {t: df.schema for t, df in tables.items()})
    asked = ("o_shipmode", " O_ORDERKEY", *ORDER_COLUMNS)
    pairs = [(t, c) for t in tables for c in asked]
    requested = rows.few_rows(spark, "table_name string, column_name string", pairs)
    counts = units.unit_counts(tables, []).select(F.col("load_table").alias("table_name"), "row_count")
    return schemas.missing_columns(metadata, requested).join(counts, "table_name")


def cast_canonical(spark, sf_dir):
    """Orders in canonical types: bigint, double, 26 and 10 characters, padding removed."""
    orders = table(spark, sf_dir, "orders")
    declared = {"__CHAR_VARCHAR_TYPE_STRING": "char(20)"}
    source = orders.select(
        F.col("o_orderkey").cast("decimal(20,0)").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("int").alias("o_custkey"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"),
        "o_orderdate",
        F.col("o_orderdate").cast("date").alias("o_orderday"),
        F.rpad("o_orderpriority", 20, " ").alias("o_orderpriority", metadata=declared),
    )
    resolved = schemas.unify({"orders": source.schema}, source.columns)
    return source.select(*schemas.conform(source, resolved))


def target_order_projection(spark, sf_dir):
    """Customer in the column order of its target, without the target's static partition column."""
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_name", "C_Name")
    target = ("c_mktsegment", "c_name", "region", "c_custkey", "c_acctbal", "c_nationkey")
    order = schemas.target_order(customer.columns, target, exclude=("REGION",))
    return customer.select(*order)


def _lists(spark, sf_dir):
    """Per user: event types in order of first use, in the first and the second half of the month."""
    events = table(spark, sf_dir, "events")
    half = F.when(F.dayofmonth("ts") <= 15, "declared").otherwise("real")
    first = events.groupBy("user_id", half.alias("half"), F.col("event_type").alias("column_name")).agg(
        F.min(F.struct("ts", "event_id")).alias("first_use")
    )
    position = Window.partitionBy("user_id", "half").orderBy("first_use")
    ranked = first.withColumn("ordinal", F.row_number().over(position))
    split = {h: ranked.where(F.col("half") == h) for h in ("declared", "real")}
    upper = split["real"].withColumn("column_name", F.upper("column_name"))
    return split["declared"], upper


def column_order_check(spark, sf_dir):
    """Declared against real column lists, one pair of lists per user."""
    return schemas.column_order_check(*_lists(spark, sf_dir), by=["user_id"])


def column_list_verdict(spark, sf_dir):
    """One verdict per pair of lists."""
    return schemas.column_list_verdict(column_order_check(spark, sf_dir), by=["user_id"])


QUERIES = {
    "schema_resolve": schema_resolve,
    "missing_columns": missing_columns,
    "cast_canonical": cast_canonical,
    "target_order_projection": target_order_projection,
    "column_order_check": column_order_check,
    "column_list_verdict": column_list_verdict,
}

def _resolved(name, kind, cast="false", length="NULL", text=False, measured=True):
    longest = f"coalesce(max(length({name})), 0)" if text else "0"
    return f"""
SELECT '{name}' AS column_name, {kind} AS resolved_type, {cast} AS needs_cast,
       CAST({length} AS INTEGER) AS max_length, CAST(2 AS BIGINT) AS table_count, false AS missing,
       CAST({longest if measured else 'NULL'} AS INTEGER) AS longest,
       {f'count({name})' if measured else 'nullif(count(*), count(*))'} AS value_count
FROM orders"""


_LISTS = """
WITH first AS (
  SELECT user_id, CASE WHEN day(ts) <= 15 THEN 'declared' ELSE 'real' END AS half, event_type,
         min(ROW(ts, event_id)) AS first_use
  FROM events GROUP BY ALL
), ranked AS (
  SELECT user_id, half, upper(event_type) AS column_key,
         CAST(row_number() OVER (PARTITION BY user_id, half ORDER BY first_use) AS INTEGER) AS ordinal
  FROM first
), checked AS (
  SELECT user_id, column_key, d.ordinal AS declared_ordinal, r.ordinal AS real_ordinal,
         CASE WHEN r.ordinal IS NULL THEN 'missing' WHEN d.ordinal IS NULL THEN 'extra'
              WHEN d.ordinal = r.ordinal THEN 'ok' ELSE 'moved' END AS verdict
  FROM (SELECT * FROM ranked WHERE half = 'declared') d
  FULL OUTER JOIN (SELECT * FROM ranked WHERE half = 'real') r USING (user_id, column_key)
)"""

ORACLES = {
    "schema_resolve": " UNION ALL ".join(
        [
            _resolved("o_orderkey", "'BIGINT'"),
            _resolved("o_custkey", "'BIGINT'"),
            _resolved("o_orderstatus", "'VARCHAR(7)'", length="7", text=True),
            _resolved("o_totalprice", "'DOUBLE'", "true"),
            _resolved("o_orderdate", "'VARCHAR(10)'", "true"),
            _resolved("o_orderpriority", "'VARCHAR(20)'", "true", length="20", text=True),
            _resolved("order_month", "'BIGINT'", measured=False),
        ]
    )
    + """ UNION ALL SELECT 'o_shipmode', NULL, NULL, NULL, NULL, true, NULL, NULL""",
    "missing_columns": """
WITH t AS (
  SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'lt1' ELSE 'lt2' END AS table_name, count(*) AS row_count
  FROM orders GROUP BY 1
)
SELECT table_name, column_name, row_count
FROM t, (VALUES ('o_shipmode', 'both'), ('o_custkey', 'lt1')) v(column_name, missing_in)
WHERE missing_in IN ('both', table_name)""",
    "cast_canonical": """
SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS DOUBLE) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderday, o_orderpriority
FROM orders""",
    "target_order_projection": """
SELECT c_mktsegment, c_name AS "C_Name", c_custkey, c_acctbal, c_nationkey FROM customer""",
    "column_order_check": _LISTS + " SELECT * FROM checked",
    "column_list_verdict": _LISTS + """
SELECT user_id,
       CASE WHEN bool_or(verdict IN ('missing', 'extra')) THEN 'different_set'
            WHEN bool_or(verdict = 'moved') THEN 'other_order' ELSE 'same' END AS verdict
FROM checked GROUP BY user_id""",
}
