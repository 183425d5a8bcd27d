"""Counting source and target independently. Only these counts decide whether a load succeeded."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partload.operators.units import unit_counts

SUCCESS, MISMATCH, FAILED = "success", "dq_mismatch", "failed"


def status(source_count: Column, target_count: Column) -> Column:
    return F.when(source_count == target_count, SUCCESS).otherwise(MISMATCH)


def partition_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(*keys, row_count); rows are counted per task before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


def source_counts(
    tables: Mapping[str, DataFrame], dynamic: Sequence[str], units: DataFrame | None = None
) -> DataFrame:
    """Rows per unit; with `units`, rows per partition value found among them.

    Rows are counted first and then stacked on the wanted values, one row each. A join would be
    pushed below the count and move source rows.
    """
    counted = unit_counts(tables, dynamic)
    if units is None or not dynamic:
        return counted
    wanted = units.select(*dynamic, F.lit(0).cast("bigint").alias("row_count"), F.lit(True).alias("_wanted"))
    stacked = counted.select(*dynamic, "row_count", F.lit(False).alias("_wanted")).unionByName(wanted)
    summed = stacked.groupBy(*dynamic).agg(
        F.sum("row_count").alias("row_count"), F.bool_or("_wanted").alias("_wanted")
    )
    return summed.where("_wanted").drop("_wanted")


def verdict(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row (source_count, target_count, status) from two frames of `row_count`."""
    sides = source.select(
        F.col("row_count").alias("s"), F.lit(0).cast("bigint").alias("t")
    ).unionByName(target.select(F.lit(0).cast("bigint").alias("s"), F.col("row_count").alias("t")))
    totals = sides.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_count"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_count"),
    )
    return totals.withColumn("status", status(F.col("source_count"), F.col("target_count")))


def partition_verdicts(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The verdict per partition value: (*keys, source_count, target_count, status).

    Both sides are stacked and summed by key, so NULL keys meet and no join is needed.
    """
    zero = F.lit(0).cast("bigint")
    sides = source.select(*keys, F.col("row_count").alias("s"), zero.alias("t")).unionByName(
        target.select(*keys, zero.alias("s"), F.col("row_count").alias("t"))
    )
    totals = sides.groupBy(*keys).agg(
        F.sum("s").alias("source_count"), F.sum("t").alias("target_count")
    )
    return totals.withColumn("status", status(F.col("source_count"), F.col("target_count")))


def proof_verdict(reported: Column, recounted: Column) -> Column:
    """A proof load passes when rows arrived and the recount equals what was reported."""
    return (recounted > 0) & (recounted == reported)
