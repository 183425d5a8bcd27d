"""Delimited text: U+001F between fields, every field quoted, quotes doubled, line feed ends a row.

Line breaks inside fields are kept, so a file is one task when read, unless its producer promises that
no field holds one (`multi_line=False`). Writers should bound file size with `max_records` (or fan
out) to keep reads parallel.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partload.functions.text import FIELD_DELIMITER, QUOTE, quote_line
from partload.sources import storage
from partload.spec import ErrorLimit

CORRUPT = "_corrupt_record"
# Ends no record: never the last character of one.
_NO_BREAK = "\x00"

_COMMON = {
    "sep": FIELD_DELIMITER,
    "quote": QUOTE,
    "escape": QUOTE,
    "lineSep": "\n",
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_options(keep_empty: bool = False) -> dict[str, str]:
    """Every field quoted. NULL is written as an empty field, or as \\N when `keep_empty`."""
    null = "\\N" if keep_empty else ""
    return {**_COMMON, "quoteAll": "true", "nullValue": null, "emptyValue": ""}


def read_options(keep_empty: bool = False, multi_line: bool = True) -> dict[str, str]:
    """An empty field reads as NULL, unless `keep_empty` tells it apart from \\N.

    Without `multi_line` files are split over tasks; a line break then ends a row wherever it is.
    """
    options = {
        **_COMMON, "multiLine": str(multi_line).lower(), "nullValue": "\\N" if keep_empty else ""
    }
    if keep_empty:
        options["emptyValue"] = ""
    return options


def write_delimited(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    max_records: int = 0,
    keep_empty: bool = False,
    mode: str = "overwrite",
) -> None:
    writer = df.write.mode(mode).options(**write_options(keep_empty))
    if max_records > 0:
        writer = writer.option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str,
    keep_empty: bool = False,
    columns: Sequence[str] | None = None,
    base_path: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Read one or many files or directories; `columns` picks and orders columns by name.

    A field that does not fit its type fails the read. Use `read_with_errors` to count such rows.
    """
    reader = spark.read.schema(schema).options(**read_options(keep_empty, multi_line)).option("mode", "FAILFAST")
    if base_path:
        reader = reader.option("basePath", base_path)
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    return df.select(*columns) if columns else df


def read_with_errors(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType
) -> DataFrame:
    """Rows with a `_corrupt_record` column holding the text of rows that do not fit the schema.

    Fields are read as text and cast here, not by the scan: a scan converts only the columns a
    query selects, so bad fields of other columns would go unseen.
    """
    text = [T.StructField(f.name, T.StringType()) for f in schema.fields]
    raw = (
        spark.read.schema(T.StructType([*text, T.StructField(CORRUPT, T.StringType())]))
        .options(**read_options())
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        # Whole rows are split into fields, so that a row with a field too few is noticed.
        .option("columnPruning", "false")
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    typed, misfit = [], F.lit(False)
    for f in schema.fields:
        field = F.col(f"`{f.name}`")
        value = field if isinstance(f.dataType, T.StringType) else field.try_cast(f.dataType)
        typed.append(value.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            misfit = misfit | (field.isNotNull() & value.isNull())
    line = quote_line(*[F.col(f"`{f.name}`") for f in schema.fields])
    corrupt = F.coalesce(F.col(CORRUPT), F.when(misfit, line))
    return raw.select(*typed, corrupt.alias(CORRUPT))


def split_read(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    keep_empty: bool = False,
    split_bytes: int | None = None,
) -> DataFrame:
    """Rows of quoted text with line breaks in fields, each file read by as many tasks as it has splits.

    The same rows as `read_delimited` gives, in any order; a field that does not fit its type fails
    the read. Empty lines between records are no rows, as in Spark's reader. Lines are written to
    the scratch folder once.
    """
    from partload.operators import records

    whole = records.whole_records(records.numbered_lines(spark, paths, split_bytes)).where(F.col(records.RECORD) != "")
    options = {
        **{k: v for k, v in read_options(keep_empty).items() if k not in ("encoding", "lineSep", "multiLine")},
        # A record is one text here, and its line breaks are inside its fields.
        "lineSep": _NO_BREAK, "mode": "FAILFAST",
    }
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return whole.select(F.from_csv(records.RECORD, ddl, options).alias("r")).select("r.*")


def error_counts(read: DataFrame) -> DataFrame:
    """(total_rows, bad_rows) of a `read_with_errors` result, in one pass.

    The total is counted through a data column, because a scan may not read the corrupt column alone.
    """
    first = F.col(next(c for c in read.columns if c != CORRUPT))
    return read.agg(
        (F.count_if(first.isNull()) + F.count_if(first.isNotNull())).alias("total_rows"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("bad_rows"),
    )


def gate(counts: DataFrame, limit: ErrorLimit) -> DataFrame:
    """Add `passed`: bad rows within the record limit, or within the share if there is no record limit.

    An unknown count fails.
    """
    bad, total = F.col("bad_rows"), F.col("total_rows")
    if limit.record is not None:
        within = bad <= limit.record
    else:
        within = bad <= total * F.lit(limit.percentage)
    return counts.withColumn("passed", F.coalesce(within, F.lit(False)))


def good_rows(read: DataFrame) -> DataFrame:
    return read.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def gated_read(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, limit: ErrorLimit
) -> DataFrame:
    """The good rows of delimited files, or an error if more rows are bad than the limit allows.

    The files are read once: the pass that counts bad rows stores the good ones in the scratch folder.
    """
    seen = Observation(f"read-{uuid.uuid4().hex}")
    bad = F.count_if(F.col(CORRUPT).isNotNull())
    read = read_with_errors(spark, paths, schema).observe(
        seen, F.count(F.lit(1)).alias("total_rows"), bad.alias("bad_rows")
    )
    folder = storage.scratch_dir(spark)
    good = storage.materialise(good_rows(read), "good", folder)
    bad_rows, total = seen.get["bad_rows"], seen.get["total_rows"]
    if not limit.allows(bad_rows, total):
        storage.delete_prefix(spark, folder)
        raise ValueError(f"{bad_rows} of {total} rows are bad, above {limit}")
    return good
