"""File-system work through Hadoop's FileSystem, so any Spark-readable path does."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partload.functions.times import date_from_path
from partload.spec import DATE_COLUMN

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


# Scratch folders made inside the innermost `scratch_scope`.
_made: ContextVar[list[str] | None] = ContextVar("scratch folders", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Gives back, at its end, the scratch folders that were made inside it.

    What leaves the scope must have been written elsewhere: a frame that still reads a scratch table
    made inside cannot be used any more.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for path in made:
            fs, jpath = _fs(spark, path)
            fs.delete(jpath, True)
            fs.cancelDeleteOnExit(jpath)


def scratch_dir(spark: SparkSession) -> str:
    """A new folder for intermediate tables, removed when the application ends.

    It lies in the shared folder the session names in spark.checkpoint.dir, or in the warehouse,
    which all executors share too, where the session names none.
    """
    base = spark.conf.get(_CHECKPOINT_DIR, None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    path = f"{base.rstrip('/')}/partload-{uuid.uuid4().hex}"
    fs, jpath = _fs(spark, path)
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


def materialise(df: DataFrame, name: str = "table", folder: str = "") -> DataFrame:
    """Write a table to a scratch folder, a new one if none is given, and read it back.

    Cuts the lineage durably, and gives the optimizer a real size to choose joins by.
    """
    spark = df.sparkSession
    path = f"{folder or scratch_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def count_files(spark: SparkSession, path: str) -> int:
    fs, jpath = _fs(spark, path)
    return fs.getContentSummary(jpath).getFileCount() if fs.exists(jpath) else 0


def delete_prefix(spark: SparkSession, path: str) -> int:
    """Delete everything under a path and return the number of files that were there."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return 0
    found = fs.getContentSummary(jpath).getFileCount()
    if not fs.delete(jpath, True):
        raise OSError(f"could not delete {path}")
    return found


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; folders above the target are made. Repeating a done move is no error."""
    fs, src = _fs(spark, source)
    dst = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst) and (fs.exists(src) or not fs.exists(dst)):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, such as a list of partition folders."""
    fs, jpath = _fs(spark, path)
    out = fs.create(jpath, True)
    try:
        out.write(text.encode())
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match a pattern."""
    fs, jpath = _fs(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(jpath) or ()]


def delete_empty_dir(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    if fs.exists(jpath) and not fs.listStatusIterator(jpath).hasNext():
        fs.delete(jpath, False)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories directly under a path."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files directly under a path; hidden ones are left out."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(jpath) if s.isFile()]
    return sorted(n for n in names if n[0] not in "._")


def list_dated_partitions(
    spark: SparkSession, base: str, date_column: str = DATE_COLUMN
) -> DataFrame:
    """(prefix, partition_date) of the dated directories directly under a base path.

    Reads directory names only; anything not named by a date is left out.
    """
    names = [(f"{base.rstrip('/')}/{n}",) for n in list_dirs(spark, base)]
    listed = spark.createDataFrame(names, "prefix string")
    return listed.withColumn(
        "partition_date", date_from_path(F.col("prefix"), date_column)
    ).where(F.col("partition_date").isNotNull())


def dated_row_counts(df: DataFrame, date_column: str = DATE_COLUMN) -> DataFrame:
    """(partition_date, file_count, row_count) from the file paths a file-based scan reads."""
    path = F.col("_metadata.file_path")
    per_file = df.groupBy(path.alias("_path")).agg(F.count(F.lit(1)).alias("_rows"))
    return (
        per_file.groupBy(date_from_path(F.col("_path"), date_column).alias("partition_date"))
        .agg(F.count(F.lit(1)).alias("file_count"), F.sum("_rows").alias("row_count"))
        .where(F.col("partition_date").isNotNull())
    )
