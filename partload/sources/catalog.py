"""Catalog work: create, describe, register and drop. Metadata only; data stays where it is."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import batched
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partload.functions.keys import NULL_PARTITION
from partload.operators.schema import ResolvedColumn, payload_columns
from partload.sources import delimited
from partload.spec import DATE_COLUMN, TargetSpec

_STATEMENT_PARTITIONS = 500


def ident(name: str) -> str:
    """A dotted name with every part quoted."""
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


def literal(value: object) -> str:
    if value is None:
        return "null"
    out = []
    for ch in str(value):
        if ch in "\\'":
            out.append("\\" + ch)
        elif ord(ch) < 32:
            out.append(f"\\u{ord(ch):04x}")
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


def spec_text(values: Mapping[str, object]) -> str:
    """`(col = 'value', ...)`; a NULL value is the default partition."""
    return "(" + ", ".join(f"{ident(k)} = {literal(v)}" for k, v in values.items()) + ")"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(ident(name))


def describe_table(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    """(name, type) of every column in table order, partition columns once and last."""
    return [(f.name, f.dataType.simpleString()) for f in spark.table(ident(name)).schema.fields]


def create_table(
    spark: SparkSession,
    target: TargetSpec,
    resolved: Sequence[ResolvedColumn],
    force: bool = False,
) -> None:
    """Create the external partitioned table of a target.

    An existing table is refused unless `force`, which replaces its definition and keeps its data.
    Partition columns are processing_date and the dynamic ones, all text.
    """
    if table_exists(spark, target.full_name):
        if not force:
            raise ValueError(f"{target.full_name} already exists")
        drop_table(spark, target.full_name)
    kept = payload_columns([c.name for c in resolved], target.partition_columns)
    types = {c.name: c.ddl_type for c in resolved}
    columns = [f"{ident(c)} {types[c]}" for c in kept]
    columns += [f"{ident(c)} string" for c in target.partition_columns]
    using, options = target.file_format, ""
    if target.file_format == "text":
        using = "csv"
        pairs = [f"{literal(k)} {literal(v)}" for k, v in delimited.read_options().items()]
        options = f" OPTIONS ({', '.join(pairs)})"
    spark.sql(
        f"CREATE TABLE {ident(target.full_name)} ({', '.join(columns)}) USING {using}{options} "
        f"PARTITIONED BY ({', '.join(ident(c) for c in target.partition_columns)}) "
        f"LOCATION {literal(target.location)}"
    )


def add_partitions(
    spark: SparkSession, name: str, specs: Iterable[Mapping[str, object]]
) -> int:
    """Register partitions at their default place under the table; those present are kept.

    Raises if the catalog refuses. Specs are taken in groups, so the caller may stream them.
    """
    done = 0
    for group in batched(specs, _STATEMENT_PARTITIONS):
        parts = " ".join(f"PARTITION {spec_text(s)}" for s in group)
        spark.sql(f"ALTER TABLE {ident(name)} ADD IF NOT EXISTS {parts}")
        done += len(group)
    return done


def add_partition(
    spark: SparkSession, name: str, spec: Mapping[str, object], location: str
) -> None:
    """Register one partition at a given location."""
    spark.sql(
        f"ALTER TABLE {ident(name)} ADD IF NOT EXISTS PARTITION {spec_text(spec)} "
        f"LOCATION {literal(location)}"
    )


def repair_table(spark: SparkSession, name: str) -> None:
    """Register every partition directory found under the table."""
    spark.sql(f"MSCK REPAIR TABLE {ident(name)}")


def show_partitions(
    spark: SparkSession, name: str, spec: Mapping[str, object] | None = None
) -> DataFrame:
    """Known partitions: `partition` as the catalog writes it."""
    clause = f" PARTITION {spec_text(spec)}" if spec else ""
    return spark.sql(f"SHOW PARTITIONS {ident(name)}{clause}")


def parse_partition(text: str) -> dict[str, str | None]:
    """`a=1/b=x%2Fy` to its values."""
    values = {}
    for part in text.split("/"):
        key, _, value = part.partition("=")
        values[unquote(key)] = None if value == NULL_PARTITION else unquote(value)
    return values


def drop_partitions(spark: SparkSession, name: str, spec: Mapping[str, object]) -> int:
    """Drop the metadata of every partition matching a full or partial spec; data is kept.

    A partial spec is expanded to the full specs first, because the catalog drops only those.
    """
    done = 0
    rows = show_partitions(spark, name, spec).toLocalIterator()
    for group in batched((parse_partition(r[0]) for r in rows), _STATEMENT_PARTITIONS):
        parts = ", ".join(f"PARTITION {spec_text(s)}" for s in group)
        spark.sql(f"ALTER TABLE {ident(name)} DROP IF EXISTS {parts}")
        done += len(group)
    return done


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop the definition. The table is external, so its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {ident(name)}")


def partition_dates(partitions: DataFrame, date_column: str = DATE_COLUMN) -> DataFrame:
    """Distinct dates of a `show_partitions` listing."""
    found = F.regexp_extract("partition", date_column + r"=(\d{4}-\d{2}-\d{2})", 1)
    return partitions.select(
        F.try_to_date(F.nullif(found, F.lit("")), "yyyy-MM-dd").alias("partition_date")
    ).where(F.col("partition_date").isNotNull()).distinct()
