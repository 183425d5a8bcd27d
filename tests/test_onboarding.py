import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partload import jobs
from partload.operators import onboarding


def schema(*names):
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


CONFIG = {
    "target_table": "Fact",
    "target_owner": "wh",
    "target_dir": "/WH.db/Fact",
    "load_owner": "stage",
    "load_tables": "f1; f2",
    "source_owner": "base",
    "source_table": "f",
    "partitions": "region=EU, date_key",
    "retention": "30",
    "columns": "b,A, date_key",
}


def test_draft_from_target_order():
    sources = {"f1": schema("a", "b", "date_key"), "f2": schema("A", "B", "DATE_KEY")}
    target = schema("b", "a", "processing_date", "region", "date_key")
    job, verdict = onboarding.draft_job(CONFIG, sources, target)
    assert job["source"] == {"owner": "stage", "load_tables": ["f1", "f2"], "columns": ["b", "a", "date_key"]}
    assert job["target"]["base_dir"] == "/wh.db/fact" and job["retention_days"] == 30
    assert job["target"]["partitions"] == [{"column": "date_key", "dynamic": True}]
    assert verdict == "same"


def test_draft_of_a_new_table_uses_source_order(spark):
    frames = {t: spark.createDataFrame([], schema("a", "b", "date_key")) for t in ("f1", "f2")}
    job, verdict = jobs.check_columns(CONFIG, frames)
    assert job["source"]["columns"] == ["a", "b", "date_key"] and verdict == "other_order"


def test_draft_fails_when_a_column_does_not_resolve():
    sources = {"f1": schema("a", "b", "date_key"), "f2": schema("a", "date_key")}
    with pytest.raises(ValueError, match="column b"):
        onboarding.draft_job(CONFIG, sources)


@pytest.mark.parametrize(
    "change,expected",
    [
        ({}, ("stage", ["f1", "f2"])),
        ({"load_tables": ""}, ("base", ["f"])),
        ({"load_owner": None}, ("base", ["f"])),
    ],
)
def test_owner_and_tables_come_from_one_pair(change, expected):
    assert onboarding.source_of({**CONFIG, **change}) == expected


def test_no_source_raises():
    with pytest.raises(ValueError):
        onboarding.source_of({"load_owner": "x", "source_table": "y"})


@pytest.mark.parametrize(
    "declared,verdict",
    [([], "none"), (["A", "b"], "same"), (["b", "a"], "other_order"), (["a"], "different_set")],
)
def test_compare_lists(spark, declared, verdict):
    assert onboarding.compare_lists(declared, ["a", "b"]) == verdict


def test_risk(spark):
    config = spark.createDataFrame(
        [
            ("moved", "tpt", None, "key"),
            ("broken", None, "", "region=EU"),
            ("worse", "", "n", None),
            ("dynamic", "write_nos", "N", "region=EU,key"),
            ("calm", "WRITE_NOS", "N", ""),
            ("skipped", "WRITE_NOS", " y", "key"),
        ],
        "target_table string, export_method string, skip string, partitions string",
    )
    history = spark.createDataFrame(
        [("broken", 10, 2, "2024-01-01"), ("worse", 4, 3, "2024-01-02"), ("calm", 5, 0, "2024-01-03"),
         ("unknown", 1, 1, "2024-01-01")],
        "target_table string, total_runs bigint, mismatch_count bigint, last_date string",
    )
    rows = jobs.rank_migration_risk(config, history)
    buckets = {r.target_table: r.bucket for r in rows.collect()}
    assert buckets == {
        "moved": "migrated", "broken": "at_risk", "worse": "at_risk", "dynamic": "at_risk", "calm": "low_risk",
    }
    ranked = onboarding.rank_at_risk(rows).collect()
    assert [r.target_table for r in ranked] == ["worse", "broken", "dynamic"]
    assert ranked[0].reasons == ["3 of 4 runs did not match"] and len(ranked[2].reasons) == 1
    assert ranked[2].total_runs == 0 and ranked[2].last_date is None
    sizes = {r.bucket: r.table_count for r in onboarding.risk_buckets(rows).collect()}
    assert sizes == {"migrated": 1, "at_risk": 3, "low_risk": 1}
    everything = jobs.rank_migration_risk(config, history, include_skipped=True)
    assert everything.where(F.col("target_table") == "skipped").first().bucket == "at_risk"
