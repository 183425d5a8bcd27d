import pytest

from partload import (
    JobSpec,
    PartitionColumn,
    RunSetting,
    SourceSpec,
    TargetSpec,
    job_from_dict,
    load_job_file,
    load_jobs_dir,
)

RAW = {
    "table_name": "fact",
    "source": {
        "database": {"owner": "STAGE", "load_tables": ["F_1", "F_2"]},
        "columns": ["ID", "EVENT_DATE_KEY", "AMOUNT"],
    },
    "target": {
        "warehouse": {"owner": "WH", "table": "FACT"},
        "base_dir": "/Warehouse.DB/Fact",
        "format": "orc",
        "partitions": [{"column": "REGION"}, {"column": "EVENT_DATE_KEY", "dynamic": True}],
    },
    "loader": "spark",
    "setting": {"error_limit": {"record": 3, "percentage": 0.1}, "speed_channel": 4},
    "retention_days": 30,
}


def test_job_from_dict():
    job = job_from_dict(RAW)
    assert job.source.load_tables == ("F_1", "F_2")
    assert job.target.base_dir == "/warehouse.db/fact"
    assert job.target.dynamic_columns == ("EVENT_DATE_KEY",)
    assert job.target.static_columns == ("REGION",)
    assert job.target.partition_columns == ("processing_date", "EVENT_DATE_KEY")
    assert job.target.full_name == "WH.FACT"
    assert job.setting.error_limit.record == 3 and job.setting.files_per_partition == 4
    assert job.retention_days == 30 and job.runnable


def test_root_keeps_its_case_and_base_dir_does_not():
    target = TargetSpec("", "t", "/A/B", root="s3a://Bucket/")
    assert target.location == "s3a://Bucket/a/b"


def test_defaults():
    raw = {
        "source": {"owner": "s", "load_tables": ["a"], "columns": ["x"]},
        "target": {"owner": "o", "table": "t", "obs_dir": "/D"},
    }
    job = job_from_dict(raw, default_name="from_file")
    assert job.table_name == "from_file" and job.target.file_format == "parquet"
    assert job.retention_days is None and job.enabled and job.setting.error_limit.record == 0


@pytest.mark.parametrize(
    "change",
    [
        {"source": {"owner": "s", "load_tables": ["a"]}},
        {"source": {"load_tables": ["a"], "columns": ["x"]}},
        {"source": {"owner": "s", "load_tables": [], "columns": ["EVENT_DATE_KEY"]}},
        {"target": {**RAW["target"], "format": "avro"}},
        {"target": {**RAW["target"], "partitions": [{"column": "NOPE", "dynamic": True}]}},
        {"setting": {"layout": "random"}},
    ],
)
def test_bad_jobs_raise(change):
    with pytest.raises(ValueError):
        job_from_dict({**RAW, **change})


def test_columns_must_sit_under_source():
    raw = {**RAW, "source": {"database": {**RAW["source"]["database"], "columns": ["ID"]}}}
    with pytest.raises(ValueError, match="source.columns"):
        job_from_dict(raw)


def test_disabled_and_legacy_jobs_do_not_run():
    assert not job_from_dict({**RAW, "enabled": False}).runnable
    assert not job_from_dict({**RAW, "loader": "legacy_export"}).runnable


def test_job_files(tmp_path):
    yaml = pytest.importorskip("yaml")
    for name in ("b", "a"):
        (tmp_path / f"{name}.yaml").write_text(yaml.safe_dump({**RAW, "table_name": None}))
    assert [j.table_name for j in load_jobs_dir(tmp_path)] == ["a", "b"]
    assert load_job_file(tmp_path / "a.yaml", root="file:/x").target.location == "file:/x/warehouse.db/fact"


def test_batch_size_is_positive():
    with pytest.raises(ValueError):
        RunSetting(values_per_batch=0)
    JobSpec("t", SourceSpec("", ("a",), ("K",)), TargetSpec("", "t", "/t", partitions=(PartitionColumn("k", True),)))
