"""Loads that are judged before they show, and swaps that are cut off."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from partload import ErrorLimit, JobSpec, PartitionColumn, RunSetting, SourceSpec, TargetSpec, jobs
from partload.operators import swap
from partload.operators.audit import AuditLog, file_sink
from partload.sources import storage

DATE = "2024-01-31"
OLD, NEW = [(1, "1", 1.0), (2, "2", 2.0)], [(3, "1", 3.0), (4, "2", 4.0)]


def table(spark, rows):
    return spark.createDataFrame([(i, int(k), str(v)) for i, k, v in rows], "id int, key int, amount string")


def sources(spark, rows, unfit=0):
    """Two load tables, so that the text amounts resolve to numbers."""
    bad = [(9, 1 + i % 2, "n/a") for i in range(unfit)]
    text = table(spark, rows).unionByName(table(spark, []) if not bad else spark.createDataFrame(bad, "id int, key int, amount string"))
    return {"a": text, "b": spark.createDataFrame([], "id int, key int, amount double")}


@pytest.fixture
def job(tmp_path):
    return JobSpec(
        "fact", SourceSpec("stage", ("a", "b"), ("id", "key", "amount")),
        TargetSpec("", "fact_swap", "fact", root=str(tmp_path / "t"), partitions=(PartitionColumn("key", True),)),
        setting=RunSetting(error_limit=ErrorLimit(record=1)),
    )


def shape(job, kind):
    if kind == "static":
        return replace(job, target=replace(job.target, partitions=()))
    if kind == "groups":
        return replace(job, setting=replace(job.setting, values_per_batch=1))
    return replace(job, replace_date=kind == "date")


def stored(spark, job, tables):
    rows = jobs.target_frame(spark, job, tables).select("id", F.col("key").cast("string"), "amount").collect()
    return sorted(tuple(r) for r in rows)


def leftovers(job):
    from pathlib import Path

    return list(Path(job.target.location).glob("_loads/**/*"))


@pytest.mark.parametrize("kind", ["static", "dynamic", "groups", "date"])
def test_a_load_above_its_limit_changes_nothing(spark, job, tmp_path, kind):
    job = shape(job, kind)
    audit = AuditLog([file_sink(spark, str(tmp_path / "audit"))])
    jobs.run(spark, job, DATE, audit, tables=sources(spark, OLD))
    above = sources(spark, NEW, unfit=2)
    with pytest.raises(ValueError, match="2 of 4 rows do not fit"):
        jobs.run(spark, job, DATE, audit, tables=above, force=True)
    assert stored(spark, job, above) == OLD
    assert not leftovers(job)
    within = sources(spark, NEW, unfit=1)
    assert jobs.run(spark, job, DATE, audit, tables=within, force=True).first().status == "dq_mismatch"
    assert stored(spark, job, within) == NEW


@pytest.mark.parametrize("kind", ["static", "dynamic"])
def test_only_unfit_rows(spark, job, kind):
    job = shape(job, kind)
    jobs.load(job, sources(spark, OLD), DATE)
    with pytest.raises(ValueError, match="2 of 2"):
        jobs.load(job, sources(spark, [], unfit=2), DATE)
    assert stored(spark, job, sources(spark, OLD)) == OLD


def test_load_one_above_its_limit(spark, job):
    jobs.load(job, sources(spark, OLD), DATE)
    with pytest.raises(ValueError):
        jobs.load_one(job, sources(spark, [], unfit=4), DATE, {"key": "1"})
    assert stored(spark, job, sources(spark, OLD)) == OLD


def test_a_failing_task_changes_nothing(spark, job):
    jobs.load(job, sources(spark, OLD), DATE)
    bad = sources(spark, NEW)
    bad["a"] = bad["a"].withColumn("amount", F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("amount")))
    with pytest.raises(Exception, match="lost"):
        jobs.load(job, bad, DATE)
    assert stored(spark, job, sources(spark, OLD)) == OLD and not leftovers(job)


@pytest.mark.parametrize("kind", ["static", "dynamic", "date"])
def test_a_swap_cut_off_anywhere_is_completed(spark, job, monkeypatch, kind):
    job = shape(job, kind)
    move = storage.move
    for survive in (0, 2, 8):
        jobs.load(job, sources(spark, OLD), DATE, whole_date=kind == "date")
        left = [survive]

        def dying(spark_, source, target):
            if left[0] == 0:
                raise KeyboardInterrupt
            left[0] -= 1
            move(spark_, source, target)

        monkeypatch.setattr(storage, "move", dying)
        monkeypatch.setattr(swap, "ThreadPoolExecutor", OneByOne)
        try:
            jobs.load(job, sources(spark, NEW), DATE, whole_date=kind == "date")
            died = False
        except KeyboardInterrupt:
            died = True
        monkeypatch.undo()
        done = swap.recover(spark, job.target.location)
        # The first move gives the journal its name: before it nothing has happened.
        assert stored(spark, job, sources(spark, OLD)) == (OLD if survive == 0 else NEW)
        assert done == (1 if died and survive else 0)
        assert swap.sweep(spark, job.target.location, DATE) == (1 if survive == 0 else 0)
        assert not leftovers(job)
        if not died:
            break
    assert not died


class OneByOne:
    def __init__(self, _):
        pass

    def __enter__(self):
        return self

    def __exit__(self, *_):
        pass

    map = staticmethod(map)


def test_the_next_load_of_the_date_completes_a_swap_first(spark, job, monkeypatch):
    jobs.load(job, sources(spark, OLD), DATE)
    monkeypatch.setattr(swap.Staged, "roll_forward", lambda self: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        jobs.load(job, sources(spark, NEW), DATE)
    monkeypatch.undo()
    assert stored(spark, job, sources(spark, OLD)) == OLD
    with pytest.raises(ValueError):
        jobs.load(job, sources(spark, OLD, unfit=3), DATE)
    assert stored(spark, job, sources(spark, OLD)) == NEW


def test_folders_with_special_names(spark, job, tmp_path):
    job = replace(job, target=replace(job.target, root=str(tmp_path / "a{b} [c]*")))
    keyed = {t: df.withColumn("key", F.lit("x/y=%z {1}")) for t, df in sources(spark, OLD).items()}
    for _ in range(2):
        jobs.load(job, keyed, DATE)
    (folder,) = swap.Staged(spark, job.target.location, "none").partitions(2) or [None]
    assert folder is None
    assert spark.read.format("parquet").load(job.target.location.replace("{", "\\{").replace("}", "\\}").replace("[", "\\[").replace("]", "\\]").replace("*", "\\*")).count() == 2
