"""Writing a load and reading it back."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partload.operators import swap
from partload.operators.schema import ResolvedColumn, conform, misfit, payload_columns
from partload.operators.units import partition_values
from partload.sources import delimited, rows, storage
from partload.spec import DATE_COLUMN, RunSetting

ORDINAL = "_load_ordinal"
MISFIT = "_load_misfit"


def load_frame(
    tables: Mapping[str, DataFrame],
    resolved: Sequence[ResolvedColumn],
    dynamic: Sequence[str],
    processing_date: str,
    empty_as_null: bool = True,
) -> DataFrame:
    """All load tables as one frame: payload, processing_date, dynamic values as text, ordinal.

    Rows with values that do not fit are marked.
    """
    dropped = {c.lower() for c in dynamic}
    payload = [c for c in resolved if c.name.lower() not in dropped]
    out = None
    for i, df in enumerate(tables.values()):
        part = df.select(
            *conform(df, payload, empty_as_null),
            F.lit(processing_date).alias(DATE_COLUMN),
            *partition_values(df, dynamic),
            F.lit(i).cast("tinyint").alias(ORDINAL),
            misfit(df, payload, empty_as_null).alias(MISFIT),
        )
        out = part if out is None else out.unionByName(part)
    return out


def target_schema(resolved: Sequence[ResolvedColumn], dynamic: Sequence[str]) -> T.StructType:
    """Schema a load is read back with: payload types, partition columns as text."""
    types = {c.name: c.target_type for c in resolved}
    fields = [
        T.StructField(c, types[c]) for c in payload_columns(list(types), [DATE_COLUMN, *dynamic])
    ]
    return T.StructType(
        fields + [T.StructField(c, T.StringType()) for c in (DATE_COLUMN, *dynamic)]
    )


def _share(df: DataFrame, shares: int) -> Column:
    """Row share computed from the row itself, so that a retried task repeats it."""
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(shares))


def arrange(df: DataFrame, keys: Sequence[str], setting: RunSetting = RunSetting()) -> DataFrame:
    """Lay rows out before a partitioned write, so that V values and T tasks do not make V x T files.

    Without dynamic keys there is one directory and nothing to move, unless a file count is asked
    for. With keys, rows meet by key; AQE splits a key that holds too much and joins small ones.
    Where AQE is off, every key is spread over salted shares instead. An asked-for file count deals
    every key to that many tasks, which AQE leaves as they are.
    """
    files = setting.files_per_partition
    if not keys:
        return df.repartition(files) if files and files > 1 else df
    if setting.layout == "asis":
        return df
    conf = df.sparkSession.conf
    tasks = int(conf.get("spark.sql.shuffle.partitions"))
    if files:
        # The shares of one key have consecutive numbers, so no two of them meet in a task.
        tasks = max(tasks, files)
        number = F.pmod(F.hash(*[F.col(k) for k in keys]) + _share(df, files), F.lit(tasks))
        return df.repartitionById(tasks, number.cast("int"))
    if conf.get("spark.sql.adaptive.enabled").lower() != "true":
        return df.repartition(*[F.col(k) for k in keys], _share(df, tasks))
    return df.hint("rebalance", *keys)


# Files of partition values that a task keeps open at once.
_OPEN_FILES = 16
_MOST_OPEN = "spark.sql.maxConcurrentOutputFileWriters"
_open_lock = Lock()
_open_users: dict[str, list] = {}


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside it write rows as they come, to a file for each value.

    Spark would sort all rows of a task by value first, and a rebalanced task is bounded by its
    compressed bytes only. Beyond `_OPEN_FILES` values in a task Spark sorts the rows that are left.
    A setting of the session's own stays. Jobs side by side share the setting; the last one resets it.
    """
    key = spark.conf.get("spark.app.id") + str(spark._jsparkSession.sessionUUID())
    with _open_lock:
        if key not in _open_users:
            _open_users[key] = [0, spark.conf.get(_MOST_OPEN)]
            if _open_users[key][1] == "0":
                spark.conf.set(_MOST_OPEN, str(_OPEN_FILES))
        _open_users[key][0] += 1
    try:
        yield
    finally:
        with _open_lock:
            _open_users[key][0] -= 1
            if not _open_users[key][0]:
                spark.conf.set(_MOST_OPEN, _open_users.pop(key)[1])


def _save(df: DataFrame, writer: DataFrameWriter, path: str, file_format: str) -> None:
    with _open_files(df.sparkSession):
        if file_format == "text":
            writer.options(**delimited.write_options()).csv(path)
        else:
            writer.format(file_format).save(path)


def write_target(
    df: DataFrame,
    location: str,
    file_format: str = "parquet",
    partition_columns: Sequence[str] = (DATE_COLUMN,),
    max_records: int = 0,
) -> None:
    """Replace exactly the partitions present in the data; siblings stay. Safe to repeat."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if max_records > 0:
        writer = writer.option("maxRecordsPerFile", max_records)
    _save(df, writer.partitionBy(*partition_columns), location, file_format)


# Rows of a staged file; the two shares that meet in one both read it.
_STAGED_ROWS = 1 << 20


def _even_shares(df: DataFrame, folder: str, shares: int) -> DataFrame:
    """The rows in `shares` tasks, whose numbers of rows differ by one at most; fewer rows make fewer tasks.

    Rows are stored by the tasks that make them and numbered by file and place, and each task reads
    one range of numbers. So a share moves as compressed columns, several times smaller than rows in a
    shuffle. Only names and row counts of the files pass the driver.
    """
    spark = df.sparkSession
    df.write.option("maxRecordsPerFile", _STAGED_ROWS).parquet(f"{folder}/rows")
    stored = spark.read.schema(df.schema).parquet(f"{folder}/rows")
    counts = stored.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    counts = sorted((r.path, r.n) for r in counts.collect())
    total, parts = sum(n for _, n in counts), []
    for i in range(shares):
        low, high, at = i * total // shares, (i + 1) * total // shares, 0
        whole, cut = [], []
        for path, n in counts:
            first, end = max(low - at, 0), min(high - at, n)
            if first < end:
                (whole if end - first == n else cut).append((path, first, end))
            at += n
        pieces = [spark.read.schema(df.schema).parquet(*[x[0] for x in whole])] if whole else []
        for path, first, end in cut:
            place = F.col("_metadata.row_index")
            piece = spark.read.schema(df.schema).parquet(path)
            pieces.append(piece.where((place >= first) & (place < end)).select(*[F.col(f"`{c}`") for c in df.columns]))
        if pieces:
            parts.append(reduce(DataFrame.union, pieces).coalesce(1))
    # Spark would take a union of one-task frames only for one task; with a frame of no task it does not.
    return reduce(DataFrame.union, [*parts, rows.empty(spark, df.schema)]) if parts else stored


def write_dir(
    df: DataFrame, path: str, file_format: str, files: int | None = None,
    partition_by: Sequence[str] = (), max_records: int = 0,
) -> None:
    """Replace a whole directory. `files` fans rows out evenly into that many files."""
    if files:
        staged = storage.scratch_dir(df.sparkSession)
        write_dir(_even_shares(df, staged, files), path, file_format, None, partition_by, max_records)
        storage.delete_prefix(df.sparkSession, staged)
        return
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if max_records > 0:
        writer = writer.option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    _save(df, writer, path, file_format)


def stage_target(
    df: DataFrame,
    staged: swap.Staged,
    file_format: str = "parquet",
    partition_columns: Sequence[str] = (DATE_COLUMN,),
    max_records: int = 0,
) -> None:
    """Write partitions to a hidden folder; `swap` makes them visible."""
    write_dir(df, staged.new, file_format, partition_by=partition_columns, max_records=max_records)


def read_target(
    spark: SparkSession, location: str, file_format: str, schema: T.StructType
) -> DataFrame:
    """A fresh read of the target. Partition columns keep their text; a missing target raises."""
    reader = spark.read.schema(schema)
    if file_format == "text":
        return reader.options(**delimited.read_options()).option("mode", "FAILFAST").csv(location)
    return reader.format(file_format).load(location)


def ensure_dir(spark: SparkSession, location: str) -> None:
    fs, path = storage._fs(spark, location)
    fs.mkdirs(path)


# Counts are pushed down by the newer file sources only.
_PUSH_DOWN = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.orc.aggregatePushdown": "true",
}


def counted_target(
    spark: SparkSession, location: str, file_format: str, schema: T.StructType, by: Sequence[str],
    where: str = "true",
) -> DataFrame:
    """(*by, row_count) of a target, planned in a session of its own that pushes counts into the scan.

    Counts come from the footers of Parquet and ORC files if `by` and `where` name partition columns
    only. Otherwise, and for delimited text, Spark plans a scan of the columns it needs.
    """
    own = spark.newSession()
    for key, value in _PUSH_DOWN.items():
        own.conf.set(key, value)
    read = read_target(own, location, file_format, schema).where(where)
    return read.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))


def footer_counts(
    spark: SparkSession, location: str, file_format: str, schema: T.StructType, by: Sequence[str],
    where: str = "true",
) -> DataFrame:
    """What `counted_target` gives, one row for each partition, counted now and stored."""
    counted = counted_target(spark, location, file_format, schema, by, where)
    path = f"{storage.scratch_dir(spark)}/counts"
    counted.write.parquet(path)
    return spark.read.schema(counted.schema).parquet(path)
