"""The jobs: plan, load, reconcile, run, prove, create, expire, rank and check."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from itertools import batched

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partload.functions.keys import escape_value
from partload.operators import loading, onboarding, reconcile, retention, swap, units
from partload.operators import schema as schemas
from partload.operators.audit import AUDIT_SCHEMA, AuditLog, audit_rows
from partload.operators.state import WRITTEN, StateTable, pending_units, reused_units
from partload.sources import catalog, rows, storage
from partload.sources.tables import read_load_tables, restrict
from partload.spec import DATE_COLUMN, ErrorLimit, JobSpec, TargetSpec

log = logging.getLogger(__name__)

Tables = Mapping[str, DataFrame]


def source_tables(spark: SparkSession, job: JobSpec) -> dict[str, DataFrame]:
    return read_load_tables(spark, job.source.owner, job.source.load_tables)


def _ordered(job: JobSpec, tables: Tables) -> dict[str, DataFrame]:
    missing = [t for t in job.source.load_tables if t not in tables]
    if missing:
        raise ValueError(f"{job.table_name}: no load table {missing}")
    return {t: tables[t] for t in job.source.load_tables}


def resolve(job: JobSpec, tables: Tables) -> list[schemas.ResolvedColumn]:
    return schemas.unify(
        {t: df.schema for t, df in _ordered(job, tables).items()},
        job.source.columns,
        strict=job.strict_types,
        preserve_types=job.preserve_types,
    )


def plan(job: JobSpec, tables: Tables, processing_date: str) -> DataFrame:
    """Every unit a date has to load, with its row count. Reads sources only."""
    resolved = resolve(job, tables)
    dynamic = job.target.dynamic_columns
    counts = units.unit_counts(_ordered(job, tables), dynamic)
    return units.describe_units(
        counts, dynamic, job.target.location, processing_date, units.numeric_columns(resolved)
    )


@dataclass(frozen=True)
class LoadResult:
    """Rows the writer saw, in all and per load table, and rows that did not fit and were left out.

    Telemetry: never the verdict.
    """

    reported: int
    by_table: dict[str, int] = field(default_factory=dict)
    failed: int = 0

    def check(self, limit: ErrorLimit) -> None:
        """Raise if more rows did not fit than the limit allows."""
        total = self.reported + self.failed
        if not limit.allows(self.failed, total):
            raise ValueError(f"{self.failed} of {total} rows do not fit their types, above {limit}")

    def __add__(self, other: LoadResult) -> LoadResult:
        names = {**self.by_table, **other.by_table}
        return LoadResult(
            self.reported + other.reported,
            {n: self.by_table.get(n, 0) + other.by_table.get(n, 0) for n in names},
            self.failed + other.failed,
        )


def _native_literal(text: str, field: T.StructField):
    """A partition text as a literal of the source type, so that filters reach the scan.

    Integer, unpadded text and date only: their texts and values match one to one. A text that is
    no such value gives NULL, since a table of that type holds none. Other types give None.
    """
    if isinstance(field.dataType, T.StringType) and schemas.declared(field)[0] != "char":
        return F.lit(text)
    if isinstance(field.dataType, (T.IntegralType, T.DateType)):
        return F.lit(text).try_cast(field.dataType)
    return None


def values_filter(df: DataFrame, scopes: Sequence[Mapping[str, str | None]]):
    """Rows of a source table whose partition values are among `scopes` (texts as in the plan)."""
    by_name = {f.name.strip().upper(): f for f in df.schema.fields}

    def test(column: str, text: str | None):
        f = by_name[column.strip().upper()]
        col = df[f"`{f.name}`"]
        if text is None:
            empty = (F.rtrim(col) == "") if schemas.declared(f)[0] == "char" else F.lit(False)
            if isinstance(f.dataType, T.StringType):
                empty = empty | (col == "")
            return col.isNull() | empty
        native = _native_literal(text, f)
        if native is None:
            return units.partition_values(df, [column])[0] == F.lit(text)
        return col == native

    one_column = len(scopes) > 0 and all(len(s) == 1 for s in scopes)
    if one_column:
        (column,) = scopes[0]
        f = by_name[column.strip().upper()]
        natives = [_native_literal(s[column], f) for s in scopes if s[column] is not None]
        if natives and all(n is not None for n in natives):
            found = df[f"`{f.name}`"].isin(natives)
            return found | test(column, None) if any(s[column] is None for s in scopes) else found
    out = F.lit(False)
    for scope in scopes:
        every = F.lit(True)
        for column, text in scope.items():
            every = every & test(column, text)
        out = out | every
    return out


# A plan of at most so many values of a column reaches the scans as a list of them, a longer one as a range.
LISTED_VALUES = 1000


def _range_filter(df: DataFrame, wanted: DataFrame, column: str):
    """Rows whose value lies between the least and the greatest of a plan; None where texts have no such order."""
    f = next(f for f in df.schema.fields if f.name.strip().upper() == column.strip().upper())
    if _native_literal("", f) is None:
        return None
    value = F.col(column).try_cast(f.dataType)
    low, high, empty = wanted.agg(
        F.min(value), F.max(value), F.bool_or(F.col(column).isNull())
    ).first()
    inside = F.lit(False) if low is None else df[f"`{f.name}`"].between(F.lit(low), F.lit(high))
    return inside | values_filter(df, [{column: None}]) if empty else inside


def prune(
    tables: Tables, wanted: DataFrame, dynamic: Sequence[str]
) -> tuple[dict[str, DataFrame], bool]:
    """Load tables with filters on the values of a unit plan that reach the scans, so that partitions,
    files and row groups of other values are not read. True: no row of another value is left.

    Only the tables of a plan of one column and few values are exact; others need `restrict` as well.
    """
    out, exact = dict(tables), len(dynamic) == 1
    for column in dynamic:
        found = wanted.select(column).distinct().limit(LISTED_VALUES + 1).collect()
        listed = len(found) <= LISTED_VALUES
        exact = exact and listed
        scopes = [{column: r[0]} for r in found]
        for name, df in out.items():
            test = values_filter(df, scopes) if listed else _range_filter(df, wanted, column)
            if test is not None:
                out[name] = df.where(test)
    return out, exact


def _write(
    job: JobSpec,
    tables: Tables,
    resolved: Sequence[schemas.ResolvedColumn],
    processing_date: str,
    scope: Callable[[DataFrame], DataFrame],
    replace_date: bool,
    before: LoadResult,
    gone: str | None = None,
) -> LoadResult:
    """Stage the rows, judge the error limit over them and those loaded `before`, then swap.

    `gone` is a partition to remove if no row is left for it.
    """
    dynamic = job.target.dynamic_columns
    names = list(tables)
    frame = scope(
        loading.load_frame(tables, resolved, dynamic, processing_date, job.empty_as_null)
    )
    arranged = loading.arrange(frame, dynamic, job.setting)
    seen = Observation(f"load-{uuid.uuid4().hex}")
    fits = ~F.col(loading.MISFIT)
    per_table = [
        F.count_if(fits & (F.col(loading.ORDINAL) == i)).alias(f"t{i}") for i in range(len(names))
    ]
    observed = arranged.observe(
        seen, F.count_if(fits).alias("rows"), F.count_if(~fits).alias("failed"), *per_table
    )
    payload = observed.where(fits).drop(loading.ORDINAL, loading.MISFIT)
    target = job.target
    staged = swap.begin(payload.sparkSession, target.location, processing_date)
    try:
        loading.stage_target(
            payload, staged, target.file_format, target.partition_columns,
            job.setting.max_records_per_file,
        )
        got = seen.get
        result = LoadResult(
            got["rows"], {n: got[f"t{i}"] for i, n in enumerate(names)}, got["failed"]
        )
        (before + result).check(job.setting.error_limit)
    except BaseException:
        staged.discard()
        raise
    date = f"{DATE_COLUMN}={escape_value(processing_date)}"
    if replace_date or not dynamic:
        # The date is swapped as a whole; a load without rows empties it.
        put, drop = ([date], []) if result.reported else ([], [date])
    else:
        put = staged.partitions(len(target.partition_columns))
        drop = [gone] if gone and not result.reported else []
    staged.publish(put, drop)
    return result


def _check_before(
    job: JobSpec, tables: Tables, resolved: Sequence[schemas.ResolvedColumn], wanted: DataFrame
) -> None:
    """Judge the error limit over all groups of a grouped load, before the first is swapped.

    Reads only the columns that may hold values that do not fit; none if no column may.
    """
    if not any(schemas.may_misfit(df.schema, resolved) for df in tables.values()):
        return
    dynamic = job.target.dynamic_columns
    frame = loading.load_frame(tables, resolved, dynamic, "", job.empty_as_null)
    counted = restrict(frame, wanted, dynamic).agg(
        F.count_if(~F.col(loading.MISFIT)).alias("rows"), F.count_if(loading.MISFIT).alias("failed")
    ).first()
    LoadResult(counted["rows"], failed=counted["failed"]).check(job.setting.error_limit)


def _failed_by_unit(
    job: JobSpec, tables: Tables, resolved: Sequence[schemas.ResolvedColumn], wanted: DataFrame
) -> DataFrame:
    """The wanted units with records_failed. Only a load that left rows out pays for this pass."""
    dynamic = job.target.dynamic_columns
    frame = loading.load_frame(tables, resolved, dynamic, "", job.empty_as_null)
    counts = frame.where(loading.MISFIT).groupBy(
        F.col(loading.ORDINAL).alias("_ordinal"), *[F.col(c).alias(f"_u_{c}") for c in dynamic]
    ).agg(F.count(F.lit(1)).alias("records_failed"))
    same = F.col("load_ordinal") == F.col("_ordinal")
    for c in dynamic:
        same = same & F.col(c).eqNullSafe(F.col(f"_u_{c}"))
    return wanted.join(counts, same, "left").select(*wanted.columns, "records_failed")


def _scopes(wanted: DataFrame, dynamic: Sequence[str]) -> Iterator[dict[str, str | None]]:
    """Distinct partition values, streamed."""
    rows = wanted.select(*dynamic).distinct().orderBy(*dynamic).toLocalIterator()
    return ({c: r[c] for c in dynamic} for r in rows)


def load(
    job: JobSpec,
    tables: Tables,
    processing_date: str,
    wanted: DataFrame | None = None,
    row_limit: int = 0,
    after_batch: Callable[[DataFrame], None] | None = None,
    whole_date: bool = False,
    complete: bool = False,
) -> LoadResult:
    """Cast, union and write; each partition is replaced as a whole.

    `wanted` restricts the load to the partition values of a unit plan. With `values_per_batch`
    the values are swapped in groups, so that a failed load resumes at the group that failed.
    `complete` says that the plan holds every value of the sources, so that no row needs looking up in it.
    `row_limit` caps the rows of each unit, for proof loads. `whole_date` clears the date first.
    Rows that do not fit their types are left out. The job's error limit decides before anything
    visible changes: a load above it raises and leaves every old partition as it was.
    """
    return _load(
        job, tables, processing_date, wanted, row_limit, after_batch, whole_date, complete
    )


def _load(
    job: JobSpec,
    tables: Tables,
    processing_date: str,
    wanted: DataFrame | None = None,
    row_limit: int = 0,
    after_batch: Callable[[DataFrame], None] | None = None,
    whole_date: bool = False,
    complete: bool = False,
    gone: str | None = None,
) -> LoadResult:
    tables = _ordered(job, tables)
    resolved = resolve(job, tables)
    dynamic = job.target.dynamic_columns
    spark = next(iter(tables.values())).sparkSession
    loading.ensure_dir(spark, job.target.location)

    def capped(frame: DataFrame) -> DataFrame:
        if row_limit <= 0:
            return frame
        marks = (DATE_COLUMN, loading.ORDINAL, loading.MISFIT)
        order = [c for c in frame.columns if c not in (*marks, *dynamic)]
        return units.first_rows(frame, [loading.ORDINAL, *dynamic], order, row_limit)

    size = job.setting.values_per_batch
    if wanted is None or not dynamic or not size:
        every = wanted is None or complete
        if not every and dynamic:
            tables, every = prune(tables, wanted, dynamic)

        def scope(frame):
            return capped(frame if every else restrict(frame, wanted, dynamic))

        result = _write(
            job, tables, resolved, processing_date, scope, whole_date, LoadResult(0), gone
        )
        if after_batch and wanted is not None:
            after_batch(
                _failed_by_unit(job, tables, resolved, wanted) if result.failed else wanted
            )
        return result
    _check_before(job, tables, resolved, wanted)
    total = LoadResult(0, {t: 0 for t in tables})
    if whole_date:
        date = f"{DATE_COLUMN}={escape_value(processing_date)}"
        swap.begin(spark, job.target.location, processing_date).publish([], [date])
    for group in batched(_scopes(wanted, dynamic), size):
        some = {t: df.where(values_filter(df, group)) for t, df in tables.items()}
        result = _write(job, some, resolved, processing_date, capped, False, total)
        total += result
        if after_batch:
            schema = T.StructType([T.StructField(c, T.StringType()) for c in dynamic])
            values = rows.few_rows(spark, schema, [tuple(g[c] for c in dynamic) for g in group])
            done = restrict(wanted, values, dynamic)
            after_batch(_failed_by_unit(job, some, resolved, done) if result.failed else done)
    return total


def load_one(
    job: JobSpec,
    tables: Tables,
    processing_date: str,
    values: Mapping[str, str | None],
    row_limit: int = 0,
) -> LoadResult:
    """Replace one partition value from all load tables. The value reaches the source scan."""
    if set(values) != set(job.target.dynamic_columns):
        raise ValueError(f"values must be given for {job.target.dynamic_columns}")
    some = {
        t: df.where(values_filter(df, [values])) if values else df
        for t, df in _ordered(job, tables).items()
    }
    gone = None
    if values:
        parts = [(DATE_COLUMN, processing_date), *((c, values[c]) for c in job.target.dynamic_columns)]
        gone = "/".join(f"{c}={escape_value(v)}" for c, v in parts)
    return _load(job, some, processing_date, row_limit=row_limit, gone=gone)


def target_frame(spark: SparkSession, job: JobSpec, tables: Tables) -> DataFrame:
    """A fresh read of the target: the registered table if there is one, else its files."""
    if catalog.table_exists(spark, job.target.full_name):
        spark.catalog.refreshTable(catalog.ident(job.target.full_name))
        return spark.table(catalog.ident(job.target.full_name))
    schema = loading.target_schema(resolve(job, tables), job.target.dynamic_columns)
    return loading.read_target(spark, job.target.location, job.target.file_format, schema)


def register(spark: SparkSession, job: JobSpec, processing_date: str, wanted: DataFrame) -> int:
    """Register the plan's partitions, if the target table exists in the catalog."""
    if not catalog.table_exists(spark, job.target.full_name):
        return 0
    dynamic = job.target.dynamic_columns
    if not dynamic:
        specs = iter([{DATE_COLUMN: processing_date}])
    else:
        specs = ({DATE_COLUMN: processing_date, **s} for s in _scopes(wanted, dynamic))
    return catalog.add_partitions(spark, job.target.full_name, specs)


def _audit_row(spark: SparkSession, job: JobSpec, processing_date: str, **values) -> DataFrame:
    row = {
        "run_id": str(uuid.uuid4()),
        "job_name": job.table_name,
        "processing_date": processing_date,
        "source_schema": job.source.owner,
        "source_table": ",".join(job.source.load_tables),
        "target_schema": job.target.owner,
        "target_table": job.target.table,
        "loader": job.loader,
        "end_time": dt.datetime.now(),
        **values,
    }
    return audit_rows(rows.one_row(spark, AUDIT_SCHEMA, row))


def reconcile_job(
    spark: SparkSession,
    job: JobSpec,
    tables: Tables,
    processing_date: str,
    wanted: DataFrame,
    reported: int | None = None,
    start: dt.datetime | None = None,
    failed: int = 0,
) -> DataFrame:
    """Register, count both sides afresh, and return the audit row."""
    start = start or dt.datetime.now()
    register(spark, job, processing_date, wanted)
    source = reconcile.source_counts(
        _ordered(job, tables), job.target.dynamic_columns, wanted
    )
    target = target_frame(spark, job, tables).where(F.col(DATE_COLUMN) == processing_date)
    counted = reconcile.verdict(source, target.agg(F.count(F.lit(1)).alias("row_count"))).first()
    return _audit_row(
        spark, job, processing_date,
        source_row_count=counted.source_count,
        target_row_count=counted.target_count,
        status=counted.status,
        reported_count=reported,
        error_detail=f"{failed} rows did not fit their types" if failed else None,
        start_time=start,
    )


def run(
    spark: SparkSession,
    job: JobSpec,
    processing_date: str,
    audit: AuditLog,
    state: StateTable | None = None,
    tables: Tables | None = None,
    force: bool = False,
    row_limit: int = 0,
) -> DataFrame | None:
    """Load one date and prove it. Returns the audit row, or None if the date already succeeded.

    With a state table a failed run resumes: finished partitions are kept and skipped. A run that
    raises leaves a `failed` audit row behind. Unit plans and other scratch tables are given back.
    """
    with storage.scratch_scope(spark):
        return _run(spark, job, processing_date, audit, state, tables, force, row_limit)


def _run(
    spark: SparkSession,
    job: JobSpec,
    processing_date: str,
    audit: AuditLog,
    state: StateTable | None,
    tables: Tables | None,
    force: bool,
    row_limit: int,
) -> DataFrame | None:
    start = dt.datetime.now()
    if not force and audit.find_success(job.table_name, processing_date):
        log.info("%s/%s already succeeded", job.table_name, processing_date)
        return None
    name = job.table_name
    try:
        tables = tables if tables is not None else source_tables(spark, job)
        every = storage.materialise(plan(job, tables, processing_date), "units")
        todo, stored = every, 0
        if state is not None and force:
            state.clear(name, processing_date)
        if state is not None and state.exists(name, processing_date):
            known = storage.materialise(state.latest(name, processing_date), "state")
            todo = storage.materialise(pending_units(every, known), "pending")
            stored = reused_units(every, known, todo).agg(
                F.coalesce(F.sum("records_read"), F.lit(0))
            ).first()[0]
        loading.ensure_dir(spark, job.target.location)
        swap.recover(spark, job.target.location, processing_date)
        result = LoadResult(0)
        clear = job.replace_date and stored == 0
        if clear or not todo.isEmpty():
            result = load(
                job, tables, processing_date, todo, row_limit,
                after_batch=(
                    (lambda u: state.append(name, processing_date, u, WRITTEN)) if state else None
                ),
                whole_date=clear,
                complete=todo is every,
            )
        row = reconcile_job(
            spark, job, tables, processing_date, every, result.reported + stored, start, result.failed
        )
    except Exception as error:
        audit.record(
            _audit_row(
                spark, job, processing_date,
                status=reconcile.FAILED, error_detail=str(error), start_time=start,
            )
        )
        raise
    audit.record(row)
    if state is not None:
        # After a mismatch too: what was written is in doubt then, so the next run loads it all again.
        state.clear(name, processing_date)
    return row


def run_all(
    spark: SparkSession,
    jobs: Sequence[JobSpec],
    processing_date: str,
    audit: AuditLog,
    state: StateTable | None = None,
    tables: Mapping[str, Tables] | None = None,
    force: bool = False,
    at_once: int = 1,
) -> DataFrame:
    """Run every enabled job, `at_once` of them side by side; one failure never stops the rest.

    Each job runs in a thread of its own with its scheduler pool (named by the job, for sessions with fair
    scheduling) and its job tag; what a failed job still has running is cancelled by that tag alone.
    Jobs side by side must not share a target location.

    Returns (job_name, outcome, error), in the order of the jobs: success, dq_mismatch, failed or skipped.
    """
    chosen = [job for job in jobs if job.runnable]
    places = [job.target.location for job in chosen]
    if at_once > 1 and len(set(places)) < len(places):
        raise ValueError("jobs that run side by side need target locations of their own")
    context = spark.sparkContext

    def one(job: JobSpec) -> tuple[str, str, str | None]:
        tag = f"partload-{uuid.uuid4().hex}"
        context.addJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", job.table_name)
        try:
            given = None if tables is None else tables[job.table_name]
            row = run(spark, job, processing_date, audit, state, given, force)
            return job.table_name, "skipped" if row is None else row.first().status, None
        except Exception as error:  # noqa: BLE001
            log.error("%s failed: %s", job.table_name, error)
            context.cancelJobsWithTag(tag)
            return job.table_name, reconcile.FAILED, str(error)
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)
            context.removeJobTag(tag)

    if at_once > 1:
        # Every job starts from its own copy of the caller's local properties.
        own = [inheritable_thread_target(spark)(one) for _ in chosen]
        with ThreadPoolExecutor(at_once) as pool:
            outcomes = list(pool.map(lambda start, job: start(job), own, chosen))
    else:
        outcomes = [one(job) for job in chosen]
    return rows.few_rows(spark, "job_name string, outcome string, error string", outcomes)


def proof_load(
    spark: SparkSession,
    job: JobSpec,
    tables: Tables,
    processing_date: str,
    row_limit: int = 5000,
    partition_limit: int = 3,
    keep_scratch: bool = False,
) -> DataFrame:
    """Load a bounded part into a scratch table and compare what was reported with a recount.

    Only the first `partition_limit` units in plan order are loaded, `row_limit` rows each.
    Returns one row (target_count, reported_count, passed, location); the scratch table and data
    are removed unless kept.
    """
    scratch = replace(
        job,
        table_name=f"{job.table_name}__proof",
        target=TargetSpec(
            owner="",
            table=f"{job.target.table}_proof_{uuid.uuid4().hex[:8]}",
            base_dir="proof",
            file_format=job.target.file_format,
            partitions=job.target.partitions,
            root=storage.scratch_dir(spark),
        ),
        setting=replace(job.setting, values_per_batch=None),
        replace_date=False,
    )
    tables = _ordered(job, tables)
    catalog.create_table(spark, scratch.target, resolve(scratch, tables))
    try:
        chosen = storage.materialise(
            units.first_units(plan(scratch, tables, processing_date), partition_limit), "units"
        )
        dynamic = scratch.target.dynamic_columns
        some = tables
        if partition_limit > 0:
            some = {
                t: _only_units(df, chosen.where(F.col("load_table") == t), dynamic)
                for t, df in tables.items()
            }
        reported = load(scratch, some, processing_date, row_limit=row_limit).reported
        register(spark, scratch, processing_date, chosen)
        counted = target_frame(spark, scratch, tables).where(
            F.col(DATE_COLUMN) == processing_date
        ).count()
        frame = rows.one_row(
            spark,
            "target_count bigint, reported_count bigint, location string",
            {
                "target_count": counted,
                "reported_count": reported,
                "location": scratch.target.location,
            },
        )
        passed = reconcile.proof_verdict(F.col("reported_count"), F.col("target_count"))
        return frame.select("target_count", "reported_count", passed.alias("passed"), "location")
    finally:
        if not keep_scratch:
            catalog.drop_table(spark, scratch.target.full_name)
            storage.delete_prefix(spark, scratch.target.location)


def _only_units(df: DataFrame, chosen: DataFrame, dynamic: Sequence[str]) -> DataFrame:
    """Source rows of one load table's chosen units; none if it has no unit among them."""
    if dynamic:
        return df.where(values_filter(df, list(_scopes(chosen, dynamic))))
    return df.where(F.lit(not chosen.isEmpty()))


def create_target(
    spark: SparkSession, job: JobSpec, tables: Tables | None = None, force: bool = False
) -> None:
    """Create the target table from the resolved source types. Loads nothing."""
    tables = tables if tables is not None else source_tables(spark, job)
    catalog.create_table(spark, job.target, resolve(job, tables), force)


def expire(
    spark: SparkSession, job: JobSpec, today: dt.date | None = None, dry_run: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Expire old dates of one job: (result rows, summary). A job without retention keeps all."""
    today = today or dt.date.today()
    listed = storage.list_dated_partitions(spark, job.target.location)
    planned = retention.retention_plan(listed, today, job.retention_days)
    name = job.target.full_name
    table = name if catalog.table_exists(spark, name) else None
    if job.retention_days is None:
        planned = planned.where(F.lit(False))
    done = retention.apply_retention(spark, planned, table, dry_run)
    marked = planned.join(done.select("partition_date", "error"), "partition_date", "left")
    return done, retention.retention_summary(marked)


def expire_all(
    spark: SparkSession,
    jobs: Sequence[JobSpec],
    today: dt.date | None = None,
    dry_run: bool = True,
) -> DataFrame:
    """Expire every job that opted in: one summary row per job."""
    out = None
    for job in jobs:
        if job.retention_days is None:
            continue
        _, summary = expire(spark, job, today, dry_run)
        row = summary.withColumn("job_name", F.lit(job.table_name))
        out = row if out is None else out.unionByName(row)
    if out is None:
        return rows.empty(
            spark, "kept_count bigint, expired_count bigint, had_errors boolean, job_name string"
        )
    return out


def rank_migration_risk(
    config: DataFrame, history: DataFrame, include_skipped: bool = False
) -> DataFrame:
    """All config tables with their bucket and reasons; see operators.onboarding."""
    return onboarding.risk_rows(config, history, include_skipped)


def check_columns(
    config: Mapping[str, str | None],
    tables: Tables,
    target: DataFrame | None = None,
) -> tuple[dict, str]:
    """Draft a job from a config row and say how its column list compares to the real one."""
    return onboarding.draft_job(
        config,
        {t: df.schema for t, df in tables.items()},
        None if target is None else target.schema,
    )
