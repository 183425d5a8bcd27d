"""The jobs end to end: runs, reruns, resumes, failures, proofs, tables and retention."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from partload import JobSpec, PartitionColumn, RunSetting, SourceSpec, TargetSpec, jobs
from partload.operators.audit import AuditLog, Sink, file_sink
from partload.operators.state import StateTable
from partload.sources import catalog, storage

DATE = "2024-01-31"
COUNTER = iter(range(10_000))


@pytest.fixture
def tables(spark):
    a = spark.createDataFrame(
        [(1, 10, "x", Decimal("1.50")), (2, 10, "", Decimal("2.50")), (3, 20, "y", None)],
        "id int, key int, name string, amount decimal(9,2)",
    )
    b = spark.createDataFrame(
        [(4, 10, "z", 4.0), (5, 30, None, 5.0), (6, None, "n", 6.0)],
        "ID bigint, KEY bigint, NAME string, AMOUNT double",
    )
    return {"a": a, "b": b}


@pytest.fixture
def job(tmp_path):
    return JobSpec(
        "fact",
        SourceSpec("stage", ("a", "b"), ("id", "key", "name", "amount")),
        TargetSpec(
            "", f"fact_{next(COUNTER)}", "Fact", root=str(tmp_path),
            partitions=(PartitionColumn("region"), PartitionColumn("key", dynamic=True)),
        ),
    )


@pytest.fixture
def audit(spark, tmp_path):
    return AuditLog([file_sink(spark, str(tmp_path / "audit"))])


@pytest.fixture
def state(spark, tmp_path):
    return StateTable(spark, str(tmp_path / "state"))


def stored(spark, job, tables):
    rows = jobs.target_frame(spark, job, tables).select("id", "key", "name", "amount").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[0])


EVERYTHING = [
    (1, "10", "x", 1.5), (2, "10", None, 2.5), (3, "20", "y", None),
    (4, "10", "z", 4.0), (5, "30", None, 5.0), (6, None, "n", 6.0),
]


def test_plan(spark, job, tables):
    rows = {r.unit_key: r for r in jobs.plan(job, tables, DATE).collect()}
    assert set(rows) == {"a:key=10", "a:key=20", "b:key=10", "b:key=30", "b:key=__HIVE_DEFAULT_PARTITION__"}
    assert rows["a:key=10"].row_count == 2 and rows["a:key=10"].where_clause == "key = 10"
    assert rows["a:key=10"].target_path == rows["b:key=10"].target_path
    assert rows["a:key=10"].target_path.endswith(f"/fact/processing_date={DATE}/key=10")
    assert rows["b:key=__HIVE_DEFAULT_PARTITION__"].where_clause == "key IS NULL"


def test_static_table_is_one_unit_per_load_table(spark, job, tables):
    flat = replace(job, target=replace(job.target, partitions=()))
    tables["b"] = tables["b"].where("false")
    rows = {r.unit_key: r.row_count for r in jobs.plan(flat, tables, DATE).collect()}
    assert rows == {"a:": 3, "b:": 0}


@pytest.mark.parametrize("file_format", ["parquet", "orc", "text"])
@pytest.mark.parametrize("registered", [False, True])
def test_run(spark, job, tables, audit, state, file_format, registered):
    job = replace(job, target=replace(job.target, file_format=file_format))
    if registered:
        jobs.create_target(spark, job, tables)
    row = jobs.run(spark, job, DATE, audit, state, tables).first()
    assert (row.status, row.source_row_count, row.target_row_count) == ("success", 6, 6)
    assert row.reported_count == 6 and row.source_table == "a,b" and row.duration_seconds > 0
    assert stored(spark, job, tables) == EVERYTHING
    if registered:
        assert catalog.show_partitions(spark, job.target.full_name).count() == 4
        catalog.drop_table(spark, job.target.full_name)
    assert jobs.run(spark, job, DATE, audit, state, tables) is None
    again = jobs.run(spark, job, DATE, audit, state, tables, force=True).first()
    assert again.target_row_count == 6 and audit.read().count() == 2


@pytest.mark.parametrize("setting", [
    RunSetting(layout="asis"),
    RunSetting(layout="rebalance"),
    RunSetting(files_per_partition=3),
    RunSetting(values_per_batch=1),
    RunSetting(max_records_per_file=1),
])
def test_every_layout_loads_the_same_rows(spark, job, tables, audit, setting):
    job = replace(job, setting=setting)
    assert jobs.run(spark, job, DATE, audit, tables=tables).first().status == "success"
    assert stored(spark, job, tables) == EVERYTHING


def test_layout_without_adaptive_execution(spark, job, tables):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        jobs.load(job, tables, DATE)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert stored(spark, job, tables) == EVERYTHING


def test_load_one_replaces_one_value_from_all_tables(spark, job, tables):
    jobs.load(job, tables, DATE)
    changed = {"a": tables["a"].withColumn("name", F.lit("new")), "b": tables["b"]}
    for _ in range(2):
        result = jobs.load_one(job, changed, DATE, {"key": "10"})
    assert result.reported == 3 and result.by_table == {"a": 2, "b": 1}
    assert stored(spark, job, tables) == [
        (1, "10", "new", 1.5), (2, "10", "new", 2.5), (3, "20", "y", None),
        (4, "10", "z", 4.0), (5, "30", None, 5.0), (6, None, "n", 6.0),
    ]
    assert jobs.load_one(job, tables, DATE, {"key": None}).reported == 1
    with pytest.raises(ValueError):
        jobs.load_one(job, tables, DATE, {"other": "1"})


def test_load_one_clears_a_value_without_rows(spark, job, tables):
    jobs.load(job, tables, DATE)
    gone = {t: df.where("key <> 20") for t, df in tables.items()}
    assert jobs.load_one(job, gone, DATE, {"key": "20"}).reported == 0
    assert [r[0] for r in stored(spark, job, tables)] == [1, 2, 4, 5, 6]


def test_static_table_is_replaced_even_by_nothing(spark, job, tables, audit):
    flat = replace(job, target=replace(job.target, partitions=()))
    assert jobs.run(spark, flat, "2024-01-30", audit, tables=tables).first().target_row_count == 6
    assert jobs.run(spark, flat, DATE, audit, tables=tables).first().target_row_count == 6
    empty = {t: df.where("false") for t, df in tables.items()}
    row = jobs.run(spark, flat, DATE, audit, tables=empty, force=True).first()
    assert (row.status, row.target_row_count) == ("success", 0)
    assert jobs.target_frame(spark, flat, tables).count() == 6


def test_padded_text_partition(spark, job, tables):
    declared = {"__CHAR_VARCHAR_TYPE_STRING": "char(5)"}
    a = tables["a"].withColumn("key", F.rpad(F.lit("EU"), 5, " ").alias("key", metadata=declared))
    a = a.withColumn("key", F.col("key").alias("key", metadata=declared))
    some = {"a": a, "b": tables["b"].withColumn("KEY", F.lit("EU"))}
    planned = jobs.plan(job, some, DATE).collect()
    assert {(r.unit_key, r.row_count) for r in planned} == {("a:key=EU", 3), ("b:key=EU", 3)}
    assert jobs.load_one(job, some, DATE, {"key": "EU"}).by_table == {"a": 3, "b": 3}


def test_load_one_by_decimal_value(spark, job, tables):
    a = tables["a"].withColumn("key", F.lit("7.10").cast("decimal(9,2)"))
    b = tables["b"].withColumn("KEY", F.lit("7.104").cast("decimal(9,3)"))
    some = {"a": a, "b": b}
    jobs.load(job, some, DATE)
    assert jobs.load_one(job, some, DATE, {"key": "7.1"}).by_table == {"a": 3, "b": 0}
    assert jobs.load_one(job, some, DATE, {"key": "7.104"}).by_table == {"a": 0, "b": 3}
    assert len(stored(spark, job, some)) == 6


def text_keys(spark, job):
    """Two text partition columns whose values coincide once joined by `_`."""
    some = spark.createDataFrame(
        [(1, "1_2", "3"), (2, "1", "2_3"), (3, "static", "static")], "id int, k string, l string"
    )
    job = replace(
        job,
        source=replace(job.source, load_tables=("a",), columns=("id", "k", "l")),
        target=replace(job.target, partitions=(PartitionColumn("k", True), PartitionColumn("l", True))),
    )
    return job, {"a": some}


def test_resume_tells_text_keys_apart(spark, job, audit, state):
    job, some = text_keys(spark, job)
    planned = storage.materialise(jobs.plan(job, some, DATE))
    assert planned.select("unit_key").distinct().count() == 3
    first = storage.materialise(planned.where("k = '1_2'"))
    jobs.load(job, some, DATE, first)
    state.append("fact", DATE, first, "written")
    row = jobs.run(spark, job, DATE, audit, state, some).first()
    assert (row.status, row.target_row_count, row.reported_count) == ("success", 3, 3)


def test_long_error_text_is_kept(spark, job, tables, audit):
    text = "x" * 5000
    bad = {t: df.withColumn("NAME", F.raise_error(F.lit(text)).cast("string")) for t, df in tables.items()}
    with pytest.raises(Exception):
        jobs.run(spark, job, DATE, audit, tables=bad)
    assert text in audit.read().first().error_detail


def test_a_run_after_a_mismatch_loads_all_again(spark, job, tables, audit, state):
    job = replace(job, setting=RunSetting(values_per_batch=1))
    with pytest.raises(Exception, match="source is gone"):
        jobs.run(spark, job, DATE, audit, state, failing(tables, 30))
    # What the state calls written is lost.
    storage.delete_prefix(spark, f"{job.target.location}/processing_date={DATE}/key=10")
    assert jobs.run(spark, job, DATE, audit, state, tables).first().status == "dq_mismatch"
    assert not state.exists("fact", DATE)
    assert jobs.run(spark, job, DATE, audit, state, tables).first().status == "success"
    assert stored(spark, job, tables) == EVERYTHING


def test_replace_date_of_an_emptied_source(spark, job, tables, audit, state):
    job = replace(job, replace_date=True)
    jobs.run(spark, job, DATE, audit, state, tables)
    empty = {t: df.where("false") for t, df in tables.items()}
    row = jobs.run(spark, job, DATE, audit, state, empty, force=True).first()
    assert (row.status, row.source_row_count, row.target_row_count) == ("success", 0, 0)


def test_names_that_need_quotes(spark, job, tables, audit):
    tables["a"].createOrReplaceTempView("order")
    job = replace(job, source=replace(job.source, owner="", load_tables=("order",)))
    assert jobs.run(spark, job, DATE, audit).first().target_row_count == 3


def failing(tables, key):
    bad = F.when(F.col("KEY") == key, F.raise_error(F.lit("source is gone"))).otherwise(F.col("NAME"))
    return {"a": tables["a"], "b": tables["b"].withColumn("NAME", bad.cast("string"))}


def test_failed_run_is_audited_and_resumes(spark, job, tables, audit, state):
    job = replace(job, setting=RunSetting(values_per_batch=1))
    with pytest.raises(Exception, match="source is gone"):
        jobs.run(spark, job, DATE, audit, state, failing(tables, 30))
    failed = audit.read().first()
    assert failed.status == "failed" and "source is gone" in failed.error_detail
    assert failed.source_row_count is None
    done = {r.unit_key for r in state.latest("fact", DATE).collect()}
    assert {"a:key=10", "a:key=20", "b:key=10"} <= done and "b:key=30" not in done
    before = {p: p.stat().st_mtime_ns for p in files_of(job, "10")}
    row = jobs.run(spark, job, DATE, audit, state, tables).first()
    assert (row.status, row.target_row_count, row.reported_count) == ("success", 6, 6)
    assert {p: p.stat().st_mtime_ns for p in files_of(job, "10")} == before
    assert stored(spark, job, tables) == EVERYTHING
    assert state.latest("fact", DATE).isEmpty()


def files_of(job, key):
    from pathlib import Path

    return sorted(Path(job.target.location).glob(f"processing_date={DATE}/key={key}/part-*"))


def test_vanished_value(spark, job, tables, audit):
    jobs.run(spark, job, DATE, audit, tables=tables)
    later = {"a": tables["a"], "b": tables["b"].where("KEY = 10")}
    stale = jobs.run(spark, job, DATE, audit, tables=later, force=True).first()
    assert (stale.status, stale.source_row_count, stale.target_row_count) == ("dq_mismatch", 4, 6)
    clean = replace(job, replace_date=True)
    fresh = jobs.run(spark, clean, DATE, audit, tables=later, force=True).first()
    assert (fresh.status, fresh.target_row_count) == ("success", 4)


def test_replace_date_keeps_other_dates_and_batches(spark, job, tables, audit, state):
    job = replace(job, replace_date=True, setting=RunSetting(values_per_batch=2))
    jobs.run(spark, job, "2024-01-30", audit, state, tables)
    jobs.run(spark, job, DATE, audit, state, tables)
    jobs.run(spark, job, DATE, audit, state, tables, force=True)
    assert jobs.target_frame(spark, job, tables).count() == 12


def test_missing_target_raises(spark, job, tables, audit):
    wanted = storage.materialise(jobs.plan(job, tables, DATE))
    with pytest.raises(Exception, match="(?i)path"):
        jobs.reconcile_job(spark, job, tables, DATE, wanted)


def test_empty_source(spark, job, tables, audit):
    empty = {t: df.where("false") for t, df in tables.items()}
    row = jobs.run(spark, job, DATE, audit, tables=empty).first()
    assert (row.status, row.source_row_count, row.target_row_count) == ("success", 0, 0)


def test_run_all_goes_on_after_a_failure(spark, job, tables, audit):
    bad = replace(job, table_name="bad", source=replace(job.source, load_tables=("nope",)))
    off = replace(job, table_name="off", enabled=False)
    given = {"bad": tables, "fact": tables, "off": tables}
    rows = jobs.run_all(spark, [bad, off, job], DATE, audit, tables=given).collect()
    assert [(r.job_name, r.outcome) for r in rows] == [("bad", "failed"), ("fact", "success")]
    rows = jobs.run_all(spark, [job], DATE, audit, tables=given).collect()
    assert [(r.job_name, r.outcome) for r in rows] == [("fact", "skipped")]


def test_sources_from_the_catalog(spark, job, tables, audit):
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    job = replace(job, source=replace(job.source, owner=""))
    assert jobs.run(spark, job, DATE, audit).first().status == "success"


@pytest.mark.parametrize("limit,expected", [(1, 1), (3, 3), (0, 5)])
def test_proof_load(spark, job, tables, limit, expected):
    row = jobs.proof_load(spark, job, tables, DATE, row_limit=1, partition_limit=limit).first()
    assert (row.target_count, row.reported_count, row.passed) == (expected, expected, True)
    assert not storage.exists(spark, row.location)
    assert not [t for t in spark.catalog.listTables() if "_proof_" in t.name]


def test_proof_load_keeps_scratch_when_asked(spark, job, tables):
    row = jobs.proof_load(spark, job, tables, DATE, keep_scratch=True).first()
    assert storage.count_files(spark, row.location) > 0


def test_proof_load_of_nothing_fails(spark, job, tables):
    empty = {t: df.where("false") for t, df in tables.items()}
    assert not jobs.proof_load(spark, job, empty, DATE).first().passed


def test_create_target(spark, job, tables):
    jobs.create_target(spark, job, tables)
    name = job.target.full_name
    assert catalog.describe_table(spark, name) == [
        ("id", "bigint"), ("name", "string"), ("amount", "double"),
        ("processing_date", "string"), ("key", "string"),
    ]
    with pytest.raises(ValueError, match="already exists"):
        jobs.create_target(spark, job, tables)
    jobs.load(job, tables, DATE)
    catalog.repair_table(spark, name)
    jobs.create_target(spark, job, tables, force=True)
    assert spark.table(name).count() == 0
    catalog.repair_table(spark, name)
    assert spark.table(name).count() == 6
    catalog.drop_table(spark, name)
    assert not catalog.table_exists(spark, name)
    assert len(stored(spark, job, tables)) == 6


def test_expire(spark, job, tables):
    job = replace(job, retention_days=10)
    jobs.create_target(spark, job, tables)
    for day in ("2024-01-20", "2024-01-21", "2024-01-22"):
        jobs.load(job, tables, day)
    catalog.repair_table(spark, job.target.full_name)
    today = dt.date(2024, 1, 31)
    done, summary = jobs.expire(spark, job, today)
    assert {(r.partition_date.day, r.would_delete) for r in done.collect()} == {(20, True), (21, True)}
    assert tuple(summary.first()) == (1, 2, False)
    assert catalog.show_partitions(spark, job.target.full_name).count() == 12
    done, summary = jobs.expire(spark, job, today, dry_run=False)
    assert all(r.objects_deleted >= 4 and r.partition_dropped for r in done.collect())
    assert tuple(summary.first()) == (1, 2, False)
    shown = catalog.show_partitions(spark, job.target.full_name)
    assert {r.partition_date for r in catalog.partition_dates(shown).collect()} == {dt.date(2024, 1, 22)}
    assert jobs.target_frame(spark, job, tables).count() == 6
    catalog.drop_table(spark, job.target.full_name)


def test_retention_is_opt_in(spark, job, tables):
    jobs.load(job, tables, "2000-01-01")
    done, summary = jobs.expire(spark, job, dt.date(2024, 1, 31), dry_run=False)
    assert done.isEmpty() and summary.first().expired_count == 0
    assert jobs.target_frame(spark, job, tables).count() == 6
    assert jobs.expire_all(spark, [job]).isEmpty()
    some = jobs.expire_all(spark, [job, replace(job, retention_days=1)], dt.date(2024, 1, 31))
    assert [(r.job_name, r.expired_count) for r in some.collect()] == [("fact", 1)]


def test_audit_needs_a_lookup_sink(spark):
    with pytest.raises(ValueError):
        AuditLog([Sink("write only", lambda df: None)])
    with pytest.raises(ValueError):
        AuditLog([])


def test_failing_sink_does_not_stop_the_run(spark, job, tables, tmp_path):
    def broken(_):
        raise OSError("down")

    log = AuditLog([Sink("broken", broken), file_sink(spark, str(tmp_path / "audit"), "parquet")])
    assert jobs.run(spark, job, DATE, log, tables=tables).first().status == "success"
    assert log.find_success("fact", DATE) and not log.find_success("fact", "2024-02-01")
