"""Table scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partload.functions.keys import match_values
from partload.sources.catalog import ident


def read_load_tables(
    spark: SparkSession, owner: str, names: Sequence[str]
) -> dict[str, DataFrame]:
    """Catalog tables of one owner by name."""
    return {n: spark.table(ident(f"{owner}.{n}" if owner else n)) for n in names}


def scoped_scan(
    df: DataFrame,
    columns: Sequence[str],
    values: Mapping[str, object] | None = None,
    casts: Mapping[str, str] | None = None,
    order_by: Sequence[str] = (),
    limit: int = 0,
) -> DataFrame:
    """Ordered projection with optional casts, a partition-value filter and a row cap.

    A cap needs an order, so that the same rows come back every time.
    """
    casts = casts or {}
    out = df.where(match_values(values or {}))
    if limit > 0:
        if not order_by:
            raise ValueError("a row cap needs order_by")
        out = out.orderBy(*[F.col(f"`{c}`") for c in order_by]).limit(limit)
    return out.select(
        *[
            F.col(f"`{c}`").cast(casts[c]).alias(c) if c in casts else F.col(f"`{c}`")
            for c in columns
        ]
    )


def restrict(df: DataFrame, units: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose partition values appear in `units`; NULL matches NULL.

    `units` should be a stored table (see storage.materialise): its real size then decides
    between a broadcast and a shuffled join.
    """
    if not columns:
        return df
    wanted = units.select(*[F.col(c).alias(f"_w_{c}") for c in columns]).distinct()
    condition = None
    for c in columns:
        test = df[c].eqNullSafe(wanted[f"_w_{c}"])
        condition = test if condition is None else condition & test
    return df.join(wanted, condition, "left_semi")


def generated_rows(spark: SparkSession, n: int, literals: Mapping[str, object]) -> DataFrame:
    """`n` rows of constants."""
    cols: list[Column] = [F.lit(v).alias(k) for k, v in literals.items()]
    return spark.range(n).select(*cols)
