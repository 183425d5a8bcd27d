"""Run queries on Spark and their SQL on DuckDB and compare rows as sets of text."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal:{value}"
    if isinstance(value, (dt.date, dt.datetime)):
        return f"{type(value).__name__}:{value.isoformat()}"
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """(matches, message)"""
    cursor = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want_names != got_names:
        return False, f"columns: got {got_names}, want {want_names}"
    if want != got:
        more, less = list((got - want).items())[:3], list((want - got).items())[:3]
        return False, f"rows {sum(got.values())}/{sum(want.values())}\n  got only {more}\n  want only {less}"
    return True, f"{sum(got.values())} rows"
