"""Jobs at once, appends repeated, quoted text in splits, row caps by threshold, scratch given back."""

import random
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from partload import JobSpec, PartitionColumn, SourceSpec, TargetSpec, jobs
from partload.operators import loading, records, units
from partload.operators.audit import AUDIT_SCHEMA, AuditLog, Sink, audit_rows, file_sink
from partload.operators.state import StateTable
from partload.sources import delimited, rows, storage

DATE = "2024-01-31"


def a_job(tmp_path, name, tables=("a",)):
    return JobSpec(
        name, SourceSpec("stage", tables, ("id", "key")),
        TargetSpec("", f"t_{name}", name, root=str(tmp_path), partitions=(PartitionColumn("key", dynamic=True),)),
    )


def test_one_failing_job_leaves_the_others(spark, tmp_path):
    tables = {"a": spark.range(20).select("id", (F.col("id") % 3).alias("key"))}
    broken = {"a": tables["a"].withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))}
    some = [a_job(tmp_path, n) for n in ("one", "bad", "two", "three")]
    audit = AuditLog([file_sink(spark, str(tmp_path / "audit"))])
    given = {j.table_name: broken if j.table_name == "bad" else tables for j in some}
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", "mine")
    try:
        out = jobs.run_all(spark, some, DATE, audit, tables=given, at_once=4).collect()
        assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") == "mine"
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    assert [(r.job_name, r.outcome) for r in out] == [
        ("one", "success"), ("bad", "failed"), ("two", "success"), ("three", "success"),
    ]
    assert not spark.sparkContext.getJobTags()
    history = audit.read().groupBy("job_name", "status").count().collect()
    assert sorted(map(tuple, history)) == [
        ("bad", "failed", 1), ("one", "success", 1), ("three", "success", 1), ("two", "success", 1),
    ]
    with pytest.raises(ValueError, match="locations of their own"):
        jobs.run_all(spark, [some[0], replace(some[0], table_name="x")], DATE, audit, tables=given, at_once=2)


def test_jobs_really_overlap(spark, tmp_path, monkeypatch):
    meet = threading.Barrier(2, timeout=60)
    run = jobs.run

    def waiting(*args, **kwargs):
        meet.wait()
        return run(*args, **kwargs)

    monkeypatch.setattr(jobs, "run", waiting)
    tables = {"a": spark.range(3).select("id", F.col("id").alias("key"))}
    some = [a_job(tmp_path, n) for n in ("p", "q")]
    audit = AuditLog([file_sink(spark, str(tmp_path / "audit"))])
    out = jobs.run_all(spark, some, DATE, audit, tables={"p": tables, "q": tables}, at_once=2)
    assert {r.outcome for r in out.collect()} == {"success"}


def test_a_repeated_append_leaves_one_row(spark, tmp_path):
    def row(run_id, date=DATE):
        values = {"run_id": run_id, "job_name": "j", "processing_date": date, "status": "success"}
        return audit_rows(rows.one_row(spark, AUDIT_SCHEMA, values))

    good = file_sink(spark, str(tmp_path / "audit"))

    def half_known(df):
        good.write(df)
        raise OSError("the answer was lost")

    log = AuditLog([Sink("half", half_known, good.read)])
    assert log.record(row("r1")) == ["half"]
    fixed = AuditLog([good])
    for batch in (row("r1"), row("r1").union(row("r2")), row("r2").union(row("r2")), row("r3", None), row("r3", None)):
        assert fixed.record(batch) == []
    assert sorted(r.run_id for r in good.read().collect()) == ["r1", "r2", "r3"]


@pytest.mark.parametrize("split", [400, 3000])
def test_quoted_text_in_splits(spark, tmp_path, split):
    rng = random.Random(split)
    pieces = ['"', "\n", "\r\n", "a b", "\x1f", "\\", '""', "\n\n", "é", "word " * 9]
    some = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))), rng.choice([None, "x", "\n"])) for i in range(300)]
    some.append((999, "line\n" * 2000, "\n"))
    df = spark.createDataFrame(some, "id int, t string, u string")
    path = str(tmp_path / "text")
    delimited.write_delimited(df.coalesce(1), path)
    lines = records.numbered_lines(spark, path, 20_000 if split == 3000 else split * 10)
    assert lines.select("block").distinct().count() > 1
    back = delimited.split_read(spark, path, df.schema, split_bytes=split * 10)
    want = delimited.read_delimited(spark, path, df.schema)
    assert back.exceptAll(want).isEmpty() and want.exceptAll(back).isEmpty()
    assert back.count() == 301
    spaced = delimited.split_read(spark, path, df.schema)
    assert spaced.count() == 301


def test_split_read_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "id int, t string")
    delimited.write_delimited(df, str(tmp_path / "none"))
    assert delimited.split_read(spark, str(tmp_path / "none"), df.schema).isEmpty()


def test_first_rows_are_those_of_the_full_sort(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 1000 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("unit"),
        F.when(F.col("id") % 700 == 0, F.lit(None)).otherwise(F.xxhash64("id") % 5000).alias("o"), "id",
    )
    for limit in (1, 7, 400):
        mine = units.first_rows(df, ["unit"], ["o", "id"], limit)
        full = units.cap_rows(df, ["unit"], ["o", "id"], limit)
        assert mine.exceptAll(full).isEmpty() and full.exceptAll(mine).isEmpty()
    assert units.first_rows(df, ["unit"], ["o", "id"], 0) is df


def test_first_rows_sort_only_what_passed_the_threshold(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    capped = units.first_rows(orders, ["o_orderstatus"], ["o_orderkey"], 5)
    tree = capped._jdf.queryExecution().executedPlan().toString()
    below = tree[tree.index("BroadcastHashJoin"):]
    assert "Sort" in tree[: tree.index("BroadcastHashJoin")] and "Sort [" not in below


def test_scratch_is_given_back(spark):
    outside = storage.scratch_dir(spark)
    with storage.scratch_scope(spark):
        inside = storage.scratch_dir(spark)
        kept = storage.materialise(spark.range(5), "kept", outside)
        with storage.scratch_scope(spark):
            inner = storage.scratch_dir(spark)
        assert not storage.exists(spark, inner) and storage.exists(spark, inside)
    assert not storage.exists(spark, inside) and kept.count() == 5


def test_compaction_loses_nothing(spark, tmp_path, monkeypatch):
    states = StateTable(spark, str(tmp_path / "state"))

    def add(*keys, status="written"):
        frame = rows.few_rows(spark, "unit_key string, row_count bigint", [(k, len(k)) for k in keys])
        states.append("j", DATE, frame, status)

    def known():
        return {r.unit_key: r.status for r in states.latest("j", DATE).collect()}

    add("a", "b")
    before = states.latest("j", DATE)
    assert states.compact("j", DATE) > 0
    add("b", "c", status="exported")
    # A reader that was planned before the compaction, and one of the snapshot with a tail.
    assert {r.unit_key for r in before.collect()} == {"a", "b"}
    assert known() == {"a": "written", "b": "exported", "c": "exported"}

    listed = storage.list_files

    def appended_meanwhile(spark_, path):
        names = listed(spark_, path)
        monkeypatch.setattr(storage, "list_files", listed)
        add("late")
        return names

    of_snapshot = states.latest("j", DATE)
    monkeypatch.setattr(storage, "list_files", appended_meanwhile)
    states.compact("j", DATE)
    assert known() == {"a": "written", "b": "exported", "c": "exported", "late": "written"}
    assert {r.unit_key for r in of_snapshot.collect()} == {"a", "b", "c"}
    states.compact("j", DATE)
    states.compact("j", DATE)
    assert known() == {"a": "written", "b": "exported", "c": "exported", "late": "written"}
    move = storage.move
    add("d")
    monkeypatch.setattr(storage, "move", lambda *_: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        states.compact("j", DATE)
    monkeypatch.setattr(storage, "move", move)
    assert known()["d"] == "written" and states.compact("j", DATE) > 0 and len(known()) == 5
    states.clear("j", DATE)
    assert not known()


@pytest.mark.parametrize("file_format,by,where,pushed", [
    ("parquet", ["day", "k"], "day = '1'", True),
    ("orc", ["day", "k"], "true", True),
    ("parquet", ["day"], "v > 3", False),
    ("text", ["day"], "true", False),
])
def test_counts_from_footers(spark, tmp_path, file_format, by, where, pushed):
    df = spark.range(500).select(
        F.col("id").alias("v"), (F.col("id") % 3).cast("string").alias("day"), (F.col("id") % 2).cast("string").alias("k")
    )
    path = str(tmp_path / "t")
    loading.write_dir(df, path, file_format, partition_by=["day", "k"])
    counted = loading.counted_target(spark, path, file_format, df.schema, by, where)
    plan = counted._jdf.queryExecution().toString()
    assert ("PushedAggregation: [COUNT(*)]" in plan) == pushed
    want = df.where(where).groupBy(*by).count()
    got = loading.footer_counts(spark, path, file_format, df.schema, by, where)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
