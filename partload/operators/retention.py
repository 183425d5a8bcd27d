"""Expiring dated partitions. Opt-in, and a dry run unless told otherwise."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partload.functions.times import cutoff
from partload.sources import catalog, rows, storage
from partload.spec import DATE_COLUMN

_DELETES_AT_ONCE = 16

EXPIRY_SCHEMA = (
    "partition_date date, prefix string, would_delete boolean, objects_deleted bigint, "
    "partition_dropped boolean, error string"
)


def retention_plan(
    partitions: DataFrame, today: dt.date | Column, days: int | Column | None
) -> DataFrame:
    """Add cutoff_date and action (expired | kept).

    A date on the cutoff is expired. Without days nothing expires.
    """
    days_col = days if isinstance(days, Column) else F.lit(days).cast("int")
    today_col = today if isinstance(today, Column) else F.lit(today)
    limit = cutoff(today_col, days_col)
    expired = F.coalesce(F.col("partition_date") <= limit, F.lit(False))
    return partitions.withColumn("cutoff_date", limit).withColumn(
        "action", F.when(expired, "expired").otherwise("kept")
    )


def retention_summary(plan: DataFrame) -> DataFrame:
    """(kept_count, expired_count, had_errors); `error` is optional in the plan."""
    error = F.col("error") if "error" in plan.columns else F.lit(None).cast("string")
    return plan.agg(
        F.count_if(F.col("action") == "kept").alias("kept_count"),
        F.count_if(F.col("action") == "expired").alias("expired_count"),
        F.coalesce(F.bool_or(F.coalesce(error, F.lit("")) != ""), F.lit(False)).alias("had_errors"),
    )


def expire_one(
    spark: SparkSession, partition_date: dt.date, prefix: str, table: str | None
) -> tuple:
    """Delete the data of one date, then its metadata. Failures are returned, not raised."""
    deleted, dropped, error = 0, False, ""
    try:
        deleted = storage.delete_prefix(spark, prefix)
        try:
            if table:
                catalog.drop_partitions(spark, table, {DATE_COLUMN: partition_date.isoformat()})
            dropped = bool(table)
        except Exception as failure:  # noqa: BLE001
            error = f"data deleted but its partition is still registered: {failure}"
    except Exception as failure:  # noqa: BLE001
        error = str(failure)
    return (partition_date, prefix, False, deleted, dropped, error)


def apply_retention(
    spark: SparkSession,
    plan: DataFrame,
    table: str | None = None,
    dry_run: bool = True,
) -> DataFrame:
    """Carry out the expired rows of a plan, one result row per date.

    Only directory names pass the driver, which asks for the deletes of many dates at a time; each
    date may be repeated, and its metadata goes last.
    """
    expired = plan.where(F.col("action") == "expired").select("partition_date", "prefix")
    if dry_run:
        return expired.select(
            "partition_date", "prefix", F.lit(True).alias("would_delete"),
            F.lit(0).cast("bigint").alias("objects_deleted"),
            F.lit(False).alias("partition_dropped"), F.lit("").alias("error"),
        )
    with ThreadPoolExecutor(_DELETES_AT_ONCE) as pool:
        done = list(
            pool.map(
                lambda r: expire_one(spark, r.partition_date, r.prefix, table),
                expired.orderBy("partition_date").toLocalIterator(),
            )
        )
    return rows.few_rows(spark, EXPIRY_SCHEMA, done)
