"""Tiny frames made of constants, planned without a Python or scan stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    fields = _schema(schema).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def one_row(
    spark: SparkSession, schema: T.StructType | str, values: Mapping[str, object]
) -> DataFrame:
    """One row; a column without a value is NULL."""
    fields = _schema(schema).fields
    return spark.range(0, 1, 1, 1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in fields]
    )


def few_rows(
    spark: SparkSession, schema: T.StructType | str, values: Sequence[Sequence[object]]
) -> DataFrame:
    """A handful of rows, such as column names or partition values of one batch."""
    fields = _schema(schema).fields
    if not values:
        return empty(spark, schema)
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, row)])
        for row in values
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
