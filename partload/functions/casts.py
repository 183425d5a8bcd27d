"""Canonical casts: every source type lands as double, bigint or string."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text layout of timestamps, 26 characters.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


_TIMES = (T.TimestampType, T.TimestampNTZType)


def _session_is_utc() -> bool:
    zone = SparkSession.active().conf.get("spark.sql.session.timeZone")
    return zone.upper() in ("UTC", "ETC/UTC", "Z")


def _wall_clock(col: Column, data_type: T.DataType) -> Column:
    """A zone-less wall clock: instants in UTC, whatever the session time zone is."""
    if isinstance(data_type, T.TimestampNTZType) or _session_is_utc():
        return col.cast("timestamp_ntz")
    seconds = F.unix_micros(col).cast("decimal(24,6)") / F.lit(1000000).cast("decimal(7,0)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )


def date_text(col: Column, data_type: T.DataType) -> Column:
    """`YYYY-MM-DD`; other types give the first ten characters of their text."""
    if isinstance(data_type, T.DateType):
        return col.cast("string")
    if isinstance(data_type, _TIMES):
        return _wall_clock(col, data_type).cast("date").cast("string")
    return F.substring(col.cast("string"), 1, 10)


def timestamp_text(col: Column, data_type: T.DataType) -> Column:
    """`YYYY-MM-DD HH:MM:SS.ffffff`, zoned values in UTC; other types give 26 characters of text.

    Formatting a wall clock goes through the session time zone, which has gaps; only in UTC is
    that safe. Elsewhere the plain text is padded instead.
    """
    if isinstance(data_type, T.DateType):
        return F.concat(col.cast("string"), F.lit(" 00:00:00.000000"))
    if not isinstance(data_type, _TIMES):
        return F.substring(col.cast("string"), 1, 26)
    if _session_is_utc():
        return F.date_format(col, TIMESTAMP_TEXT)
    text = _wall_clock(col, data_type).cast("string")
    pointed = F.when(text.contains("."), text).otherwise(F.concat(text, F.lit(".")))
    return F.rpad(pointed, 26, "0")


def partition_text(col: Column, data_type: T.DataType) -> Column:
    """The text a partition value has in a directory name.

    Equal numbers give equal text across load tables: 7, 7.00 and 7.0 are all `7`.
    An empty string is NULL, because both share one directory.
    """
    if isinstance(data_type, T.DecimalType):
        text = col.cast("string")
        if data_type.scale > 0:
            text = F.regexp_replace(text, r"\.?0+$", "")
        return text
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        number = col.cast("double")
        whole = number.try_cast("bigint")
        return F.when(whole.cast("double") == number, whole.cast("string")).otherwise(
            number.cast("string")
        )
    if isinstance(data_type, T.DateType):
        return date_text(col, data_type)
    if isinstance(data_type, _TIMES):
        return timestamp_text(col, data_type)
    return F.nullif(col.cast("string"), F.lit(""))
