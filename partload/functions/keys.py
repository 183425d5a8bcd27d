"""Keys, labels and paths of load units and partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the directory name of a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# Characters a partition directory name holds as %XX.
_ESCAPED = "%\"#'*/:=?\\{[]^" + "".join(chr(c) for c in (*range(1, 32), 127))


def escape_value(value: str | None) -> str:
    """A partition value as its directory name holds it."""
    if value is None or value == "":
        return NULL_PARTITION
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def escape_col(col: Column) -> Column:
    """`escape_value` over a column. Rows without special characters skip the replacements."""
    replaced = reduce(
        lambda c, ch: F.replace(c, F.lit(ch), F.lit(f"%{ord(ch):02X}")), _ESCAPED, col
    )
    plain = col.rlike(r"^[A-Za-z0-9_.+-]+$")
    return F.coalesce(F.when(plain, col).otherwise(F.nullif(replaced, F.lit(""))), F.lit(NULL_PARTITION))


def values_map(names: Sequence[str]) -> Column:
    """Partition columns of a row as map(name, value)."""
    if not names:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).cast("string") for n in names])
    )


def sorted_entries(values: Column) -> Column:
    """A map as an array of entries in key order, so that equal maps compare equal."""
    return F.array_sort(F.map_entries(values))


def unit_label(values: Column) -> Column:
    """Values joined by `_`, in partition-column order; empty for a unit without values."""
    return F.array_join(F.map_values(values), "_", NULL_PARTITION)


def relative_path(values: Column) -> Column:
    """`col=value/...`, escaped, so that different values never share one."""
    parts = F.transform(
        F.map_entries(values), lambda e: F.concat(e["key"], F.lit("="), escape_col(e["value"]))
    )
    return F.array_join(parts, "/")


def unit_key(load_table: Column, values: Column) -> Column:
    """Tells units apart: labels are for display and may coincide, paths do not."""
    return F.concat(escape_col(load_table), F.lit(":"), relative_path(values))


def partition_path(base: str, date_column: str, date: Column, values: Column) -> Column:
    """`base/processing_date=D/col=value/...`"""
    head = F.concat(F.lit(f"{base.rstrip('/')}/{date_column}="), date)
    return F.concat_ws("/", head, F.nullif(relative_path(values), F.lit("")))


def partition_spec_text(values: Column) -> Column:
    """`col="value", ...`"""
    pairs = F.transform(
        F.map_entries(values),
        lambda e: F.concat(
            e["key"], F.lit('="'), F.coalesce(e["value"], F.lit(NULL_PARTITION)), F.lit('"')
        ),
    )
    return F.array_join(pairs, ", ")


def where_text(names: Sequence[str], numeric: Sequence[str] = ()) -> Column:
    """`col = value AND ...` as filter text; values of non-numeric columns are quoted."""
    quote = F.lit("'")
    parts = []
    for name in names:
        value = F.col(name).cast("string")
        if name in numeric:
            text = value
        else:
            text = F.concat(quote, F.replace(value, quote, F.lit("''")), quote)
        parts.append(
            F.coalesce(F.concat(F.lit(f"{name} = "), text), F.lit(f"{name} IS NULL"))
        )
    return F.concat_ws(" AND ", *parts) if parts else F.lit("")


def match_values(values: Mapping[str, object]) -> Column:
    """Conjunction of equalities; a None value matches NULL. An empty mapping matches every row.

    Plain equality is used for values so that the filter reaches the scan.
    """
    tests = [F.col(k).isNull() if v is None else F.col(k) == F.lit(v) for k, v in values.items()]
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(True)
