"""Load units: the (load table, partition values) pairs a date has to load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partload.functions import keys
from partload.functions.casts import partition_text
from partload.operators.schema import ResolvedColumn, declared
from partload.sources import storage
from partload.spec import DATE_COLUMN

_BUCKETS = 256
_SAMPLE = 64


def partition_values(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Partition columns of one source table as directory text."""
    by_name = {f.name.strip().upper(): f for f in df.schema.fields}
    out = []
    for column in columns:
        f = by_name.get(column.strip().upper())
        if f is None:
            raise ValueError(f"partition column {column} not found among {df.columns}")
        value = df[f"`{f.name}`"]
        if declared(f)[0] == "char":
            value = F.rtrim(value)
        out.append(partition_text(value, f.dataType).alias(column))
    return out


def unit_counts(tables: Mapping[str, DataFrame], dynamic: Sequence[str]) -> DataFrame:
    """Rows per unit: (load_table, load_ordinal, *dynamic, row_count).

    One column-pruned pass; rows are counted per task before the shuffle, so one value holding
    most rows costs no more than any other. A table without dynamic columns is one unit, even when
    it is empty.
    """
    frames = [
        df.select(
            F.lit(table).alias("load_table"),
            F.lit(i).alias("load_ordinal"),
            *partition_values(df, dynamic),
        )
        for i, (table, df) in enumerate(tables.items())
    ]
    if not dynamic:
        per_table = [
            frame.agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(table).alias("load_table"), F.lit(i).alias("load_ordinal"), "row_count")
            for i, (table, frame) in enumerate(zip(tables, frames))
        ]
        return reduce(DataFrame.unionByName, per_table)
    grouped = reduce(DataFrame.unionByName, frames).groupBy("load_table", "load_ordinal", *dynamic)
    return grouped.agg(F.count(F.lit(1)).alias("row_count"))


def describe_units(
    counts: DataFrame,
    dynamic: Sequence[str],
    base: str,
    processing_date: str | Column,
    numeric: Sequence[str] = (),
) -> DataFrame:
    """Unit rows from unit counts: values, label, key, filter text and target path."""
    date = F.lit(processing_date) if isinstance(processing_date, str) else processing_date
    values = keys.values_map(dynamic)
    labelled = counts.withColumn("partition_values", values).withColumn(
        "file_label", keys.unit_label(F.col("partition_values"))
    )
    return labelled.select(
        "load_table",
        "load_ordinal",
        *dynamic,
        "partition_values",
        keys.where_text(dynamic, numeric).alias("where_clause"),
        "file_label",
        keys.unit_key(F.col("load_table"), F.col("partition_values")).alias("unit_key"),
        keys.partition_path(base, DATE_COLUMN, date, F.col("partition_values")).alias("target_path"),
        "row_count",
    )


def numeric_columns(resolved: Sequence[ResolvedColumn]) -> list[str]:
    return [c.name for c in resolved if c.family in ("decimal", "integer")]


def target_partitions(units: DataFrame) -> DataFrame:
    """Distinct target partitions over all units: partition_values, partition_spec, target_path.

    Units of several load tables share a partition; each path appears once.
    """
    return units.groupBy("target_path").agg(
        F.first("partition_values").alias("partition_values"),
        F.first(keys.partition_spec_text(F.col("partition_values"))).alias("partition_spec"),
        F.sum("row_count").alias("row_count"),
    )


def first_units(units: DataFrame, limit: int) -> DataFrame:
    """The first units in plan order (load table, then label); 0 means all."""
    if limit <= 0:
        return units
    return units.orderBy("load_ordinal", "file_label").limit(limit)


def cap_rows(
    df: DataFrame, unit_columns: Sequence[str], order_columns: Sequence[str], limit: int
) -> DataFrame:
    """The first `limit` rows of every unit in the given order.

    Two rounds: each input task keeps its own first rows, groups of tasks merge theirs, and only
    then does one reducer per unit see at most groups x limit rows. The order must be total.
    """
    if limit <= 0:
        return df
    order = [F.col(c) for c in order_columns]
    bucket, rank = "_bucket", "_rank"
    merged = Window.partitionBy(*unit_columns, bucket).orderBy(*order)
    final = Window.partitionBy(*unit_columns).orderBy(*order)
    return (
        df.withColumn(bucket, F.spark_partition_id() % _BUCKETS)
        .withColumn(rank, F.row_number().over(merged))
        .where(F.col(rank) <= limit)
        .withColumn(rank, F.row_number().over(final))
        .where(F.col(rank) <= limit)
        .drop(bucket, rank)
    )


def first_rows(
    df: DataFrame, unit_columns: Sequence[str], order_columns: Sequence[str], limit: int
) -> DataFrame:
    """What `cap_rows` gives, without sorting every input row.

    A sample by row hash, one row in `_SAMPLE`, gives every unit with enough rows a threshold: the
    sample's `limit`-th row, which at least `limit` rows of the unit do not exceed. Rows above it go
    unsorted; about `limit` x `_SAMPLE` rows of a unit are left to be ranked. The thresholds are
    written, so that their real size decides how they are joined. Reads `df` twice.
    """
    if limit <= 0:
        return df
    place = F.struct(*[F.col(c) for c in order_columns])
    hashed = F.xxhash64(*[F.col(c) for c in (*unit_columns, *order_columns)])
    first = Window.partitionBy(*unit_columns).orderBy(*[F.col(c) for c in order_columns])
    ranked = df.where(F.pmod(hashed, F.lit(_SAMPLE)) == 0).withColumn("_rank", F.row_number().over(first))
    limits = ranked.where(F.col("_rank") <= limit).where(F.col("_rank") == limit).select(
        *[F.col(c).alias(f"_unit_{c}") for c in unit_columns], place.alias("_most")
    )
    limits = storage.materialise(limits, "thresholds")
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(limits[f"_unit_{c}"]) for c in unit_columns])
    left = df.join(limits, same, "left").where(F.col("_most").isNull() | (place <= F.col("_most")))
    return cap_rows(left.select(*df.columns), unit_columns, order_columns, limit)
