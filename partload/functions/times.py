"""Dates and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_from_path(path: Column, date_column: str = "processing_date") -> Column:
    """The date in a `processing_date=YYYY-MM-DD` directory name; NULL where there is none."""
    found = F.regexp_extract(path, date_column + r"=(\d{4}-\d{2}-\d{2})(?:/|$)", 1)
    return F.try_to_date(F.nullif(found, F.lit("")), "yyyy-MM-dd")


def cutoff(today: Column, days: Column) -> Column:
    return F.date_sub(today, days)


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with their fraction."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)
