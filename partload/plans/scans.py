"""Scans, constant rows, and file layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from partload.operators import loading
from partload.operators.units import partition_values
from partload.plans.inputs import table
from partload.sources import storage, tables

_SCAN_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
_SCOPE = {"l_returnflag": "A", "l_linestatus": "F"}


def scoped_scan(spark, sf_dir):
    """Ordered projection with a cast under a two-column partition-value filter."""
    return tables.scoped_scan(
        table(spark, sf_dir, "lineitem"), _SCAN_COLUMNS, _SCOPE, casts={"l_shipdate": "date"}
    )


def capped_scan(spark, sf_dir):
    """The same scan with a row cap under a total order."""
    columns = _SCAN_COLUMNS[:4]
    return tables.scoped_scan(
        table(spark, sf_dir, "lineitem"), columns, _SCOPE, order_by=columns, limit=100
    )


def partition_parallel_read(spark, sf_dir):
    """Rows and key range per partition value, all values in one scan."""
    orders = table(spark, sf_dir, "orders")
    return (
        orders.select(*partition_values(orders, ["o_orderstatus"]), "o_orderkey")
        .groupBy("o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("o_orderkey").alias("min_key"),
            F.max("o_orderkey").alias("max_key"),
        )
    )


def generated_rows(spark, sf_dir):
    """A control load: as many constant rows as lineitem has, written and recounted."""
    n = table(spark, sf_dir, "lineitem").count()
    path = storage.scratch_dir(spark) + "/control"
    rows = tables.generated_rows(spark, n, {"col1": "smoke_test", "col2": 2**40})
    loading.write_dir(rows, path, "parquet")
    back = loading.read_target(spark, path, "parquet", "col1 string, col2 bigint")
    return back.groupBy("col1", "col2").agg(F.count(F.lit(1)).alias("row_count"))


def even_fanout(spark, sf_dir):
    """Rows fanned out into exactly four files of even size."""
    path = storage.scratch_dir(spark) + "/fanout"
    loading.write_dir(table(spark, sf_dir, "lineitem"), path, "parquet", files=4)
    per_file = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_file.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("n").alias("row_count"),
        (F.max("n") - F.min("n") <= F.avg("n") * 0.05).alias("even"),
    )


def format_roundtrip(spark, sf_dir):
    """Orders written and read back in every target format."""
    orders = table(spark, sf_dir, "orders")
    base = storage.scratch_dir(spark)
    out = None
    for fmt in ("orc", "parquet", "text"):
        loading.write_dir(orders, f"{base}/{fmt}", fmt)
        back = loading.read_target(spark, f"{base}/{fmt}", fmt, orders.schema)
        row = back.agg(
            F.lit(fmt).alias("file_format"),
            F.count(F.lit(1)).alias("row_count"),
            F.sum("o_orderkey").alias("key_sum"),
            F.max("o_totalprice").alias("max_price"),
            F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("last_date"),
        )
        out = row if out is None else out.unionByName(row)
    return out


QUERIES = {
    "scoped_scan": scoped_scan,
    "capped_scan": capped_scan,
    "partition_parallel_read": partition_parallel_read,
    "generated_rows": generated_rows,
    "even_fanout": even_fanout,
    "format_roundtrip": format_roundtrip,
}

_FORMAT_ROW = """
SELECT '{fmt}' AS file_format, count(*) AS row_count, CAST(sum(o_orderkey) AS BIGINT) AS key_sum,
       max(o_totalprice) AS max_price, strftime(max(o_orderdate), '%Y-%m-%d') AS last_date
FROM orders"""

ORACLES = {
    "scoped_scan": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'""",
    "capped_scan": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100""",
    "partition_parallel_read": """
SELECT o_orderstatus, count(*) AS row_count, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key
FROM orders GROUP BY o_orderstatus""",
    "generated_rows": """
SELECT 'smoke_test' AS col1, CAST(1099511627776 AS BIGINT) AS col2, count(*) AS row_count FROM lineitem""",
    "even_fanout": """
SELECT CAST(4 AS BIGINT) AS file_count, count(*) AS row_count, true AS even FROM lineitem""",
    "format_roundtrip": " UNION ALL ".join(
        _FORMAT_ROW.format(fmt=f) for f in ("orc", "parquet", "text")
    ),
}
