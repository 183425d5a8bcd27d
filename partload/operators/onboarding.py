"""Deciding which tables to move first, and drafting their jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partload.functions.text import has_dynamic_partition
from partload.operators import schema as schemas
from partload.sources import rows
from partload.spec import DATE_COLUMN

# The export method of a moved table, and the one assumed when none is given.
MIGRATED_METHOD = "TPT"
DEFAULT_METHOD = "WRITE_NOS"


def _filled(col: Column, default: str) -> Column:
    return F.upper(F.trim(F.coalesce(F.nullif(col, F.lit("")), F.lit(default))))


def risk_rows(config: DataFrame, history: DataFrame, include_skipped: bool = False) -> DataFrame:
    """Config rows with their run history and risk flags.

    `config`: target_table, export_method, skip, partitions. `history`: target_table, total_runs,
    mismatch_count, last_date, already aggregated to one row per table.
    """
    filled = config.select(
        "target_table",
        _filled(F.col("export_method"), DEFAULT_METHOD).alias("export_method"),
        _filled(F.col("skip"), "N").alias("skip"),
        F.coalesce("partitions", F.lit("")).alias("partitions"),
    )
    if not include_skipped:
        filled = filled.where(F.col("skip") != "Y")
    joined = filled.join(history, "target_table", "left").na.fill(
        0, ["total_runs", "mismatch_count"]
    )
    migrated = F.col("export_method") == MIGRATED_METHOD
    dynamic = has_dynamic_partition(F.col("partitions"))
    at_risk = ~migrated & ((F.col("mismatch_count") > 0) | dynamic)
    return joined.select(
        *joined.columns,
        dynamic.alias("has_dynamic_partition"),
        F.when(migrated, "migrated").when(at_risk, "at_risk").otherwise("low_risk").alias("bucket"),
    ).withColumn("reasons", risk_reasons())


def risk_reasons() -> Column:
    """Reasons as an array of text; empty when there are none."""
    mismatches = F.format_string(
        "%d of %d runs did not match", F.col("mismatch_count"), F.col("total_runs")
    )
    shape = F.concat(
        F.lit("dynamic partition ("), F.col("partitions"), F.lit(") on method "), F.col("export_method")
    )
    return F.array_compact(
        F.array(
            F.when(F.col("mismatch_count") > 0, mismatches),
            F.when(
                F.col("has_dynamic_partition") & (F.col("export_method") != MIGRATED_METHOD), shape
            ),
        )
    )


def rank_at_risk(rows: DataFrame) -> DataFrame:
    """Tables at risk, most mismatches first, then by name."""
    return rows.where(F.col("bucket") == "at_risk").orderBy(
        F.col("mismatch_count").desc(), F.col("target_table").asc()
    )


def risk_buckets(rows: DataFrame) -> DataFrame:
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("table_count"))


def split_names(text: str | None, separator: str = ",") -> list[str]:
    return [p.strip() for p in (text or "").split(separator) if p.strip()]


def source_of(config: Mapping[str, str | None]) -> tuple[str, list[str]]:
    """(owner, load tables) of a config row. Owner and names always come from the same pair."""
    if config.get("load_owner") and config.get("load_tables"):
        return config["load_owner"], split_names(config["load_tables"], ";")
    if config.get("source_owner") and config.get("source_table"):
        return config["source_owner"], [config["source_table"]]
    raise ValueError("neither load tables nor a source table with their owner are given")


def draft_job(
    config: Mapping[str, str | None],
    sources: Mapping[str, T.StructType],
    target: T.StructType | None = None,
) -> tuple[dict, str]:
    """A job draft as a dict, and how the config's own column list compares to the real one.

    Real order is the target's when it exists, else that of the first load table. Every column
    must resolve over all sources. Comparison: same, other_order, different_set or none.
    """
    owner, load_tables = source_of(config)
    fixed = [p.split("=", 1)[0].strip() for p in split_names(config.get("partitions")) if "=" in p]
    dynamic = [p for p in split_names(config.get("partitions")) if "=" not in p]
    if target is not None:
        real = schemas.payload_columns(target.fieldNames(), [DATE_COLUMN, *fixed])
    else:
        real = schemas.payload_columns(sources[load_tables[0]].fieldNames(), fixed)
    if not real:
        raise ValueError("no usable columns")
    schemas.unify({t: sources[t] for t in load_tables}, real, strict=False)
    days = config.get("retention")
    job = {
        "table_name": config["target_table"].lower(),
        "source": {"owner": owner, "load_tables": load_tables, "columns": real},
        "target": {
            "owner": config.get("target_owner") or "",
            "table": config["target_table"],
            "base_dir": (config.get("target_dir") or "").lower(),
            "format": "parquet",
            "partitions": [{"column": c, "dynamic": True} for c in dynamic],
        },
        "retention_days": int(days) if days else None,
    }
    return job, compare_lists(split_names(config.get("columns")), real)


def compare_lists(declared: Sequence[str], real: Sequence[str]) -> str:
    """same, other_order, different_set, or none if nothing is declared; see column_list_verdict."""
    if not declared:
        return "none"
    spark = SparkSession.active()

    def listed(names: Sequence[str]) -> DataFrame:
        return rows.few_rows(spark, "column_name string, ordinal int", list(zip(names, range(len(names)))))

    checked = schemas.column_order_check(listed(declared), listed(real))
    return schemas.column_list_verdict(checked).first().verdict
