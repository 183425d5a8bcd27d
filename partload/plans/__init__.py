"""Query plans over the star-schema tables, one per operator, with the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from partload.plans import history, loads, onboarding, retention, scans, schema, text, verify

_MODULES = (scans, schema, text, loads, verify, history, retention, onboarding)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for module in _MODULES:
        out.update(module.QUERIES)
    return out


def oracles() -> dict[str, str]:
    out = {}
    for module in _MODULES:
        out.update(module.ORACLES)
    return out
