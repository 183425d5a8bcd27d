"""Text helpers over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELD_DELIMITER = "\x1f"
QUOTE = '"'


def norm_name(col: Column) -> Column:
    """Name as compared: trimmed and upper case."""
    return F.upper(F.trim(col))


def split_list(col: Column, separator: str = ",") -> Column:
    """Separated text to an array of trimmed parts; blank parts are dropped, NULL gives []."""
    parts = F.transform(
        F.split(F.coalesce(col, F.lit("")), F.lit(f"[{separator}]")), lambda p: F.trim(p)
    )
    return F.filter(parts, lambda p: p != "")


def static_partitions(col: Column) -> Column:
    """Names of the `name=literal` parts of a partition list."""
    fixed = F.filter(split_list(col), lambda p: p.contains("="))
    return F.transform(fixed, lambda p: F.trim(F.split_part(p, F.lit("="), F.lit(1))))


def dynamic_partitions(col: Column) -> Column:
    """The bare names of a partition list."""
    return F.filter(split_list(col), lambda p: ~p.contains("="))


def has_dynamic_partition(col: Column) -> Column:
    return F.exists(split_list(col), lambda p: ~p.contains("="))


def empty_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def quote_field(col: Column) -> Column:
    """Field wrapped in quotes with inner quotes doubled; NULL is written as an empty field."""
    inner = F.replace(F.coalesce(col, F.lit("")), F.lit(QUOTE), F.lit(QUOTE * 2))
    return F.concat(F.lit(QUOTE), inner, F.lit(QUOTE))


def quote_line(*cols: Column, delimiter: str = FIELD_DELIMITER) -> Column:
    return F.concat_ws(delimiter, *[quote_field(c) for c in cols])


_URI = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/]+)(/.*)$"


def split_uri(col: Column, strict: bool = False) -> Column:
    """`scheme://host/path` to struct(host, path). No match: NULL, or an error when strict."""
    parts = F.struct(
        F.regexp_extract(col, _URI, 1).alias("host"),
        F.regexp_extract(col, _URI, 2).alias("path"),
    )
    other = F.lit(None)
    if strict:
        other = F.when(
            col.isNotNull(), F.raise_error(F.concat(F.lit("not a host and path: "), col))
        )
    return F.when(col.rlike(_URI), parts).otherwise(other)


def without_scheme(col: Column) -> Column:
    return F.regexp_replace(col, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")


def with_scheme(col: Column, scheme: str) -> Column:
    return F.regexp_replace(col, r"^[A-Za-z][A-Za-z0-9+.-]*://", f"{scheme}://")
