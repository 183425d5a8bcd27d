"""Inputs the plans share: tables, load tables and the orders job."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partload.sources import storage
from partload.spec import JobSpec, PartitionColumn, SourceSpec, TargetSpec

DATE = "2024-01-31"
MONTH = "order_month"

# SQL text of the dynamic partition value of an order.
MONTH_SQL = "year(o_orderdate) * 100 + month(o_orderdate)"
MONTH_TEXT_SQL = f"CAST({MONTH_SQL} AS VARCHAR)"
LOAD_TABLE_SQL = "CASE WHEN o_orderkey % 2 = 0 THEN 'lt1' ELSE 'lt2' END"

ORDER_COLUMNS = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
    MONTH,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def month() -> F.Column:
    return F.year("o_orderdate") * 100 + F.month("o_orderdate")


def order_tables(spark: SparkSession, sf_dir: str, mixed_types: bool = False) -> dict[str, DataFrame]:
    """All orders as two load tables; with `mixed_types` the second declares other types.

    The tables split orders by key parity and are always loaded together.
    """
    orders = table(spark, sf_dir, "orders").withColumn(MONTH, month())
    first = orders.where(F.col("o_orderkey") % 2 == 0)
    second = orders.where(F.col("o_orderkey") % 2 == 1)
    if mixed_types:
        second = second.select(
            F.col("o_orderkey").cast("int").alias("O_ORDERKEY"),
            "o_custkey",
            "o_orderstatus",
            F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"),
            F.col("o_orderdate").cast("date").alias("o_orderdate"),
            "o_orderpriority",
            MONTH,
        )
    return {"lt1": first, "lt2": second}


def orders_job(spark: SparkSession, **changes) -> JobSpec:
    """The orders job, writing to a new scratch folder."""
    job = JobSpec(
        table_name="orders",
        source=SourceSpec("stage", ("lt1", "lt2"), ORDER_COLUMNS),
        target=TargetSpec(
            owner="",
            table="orders_target",
            base_dir="orders",
            partitions=(PartitionColumn(MONTH, dynamic=True),),
            root=storage.scratch_dir(spark),
        ),
    )
    return replace(job, **changes)
