"""A session for tests and local runs. On a cluster, pass the session you have."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "partload", cpus: int | None = None, **conf: str) -> SparkSession:
    cpus = cpus or os.cpu_count() or 1
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
