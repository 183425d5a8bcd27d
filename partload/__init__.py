"""Load tables into date-partitioned storage and prove the load by counting, on Spark."""

from partload.spec import (
    ErrorLimit,
    JobSpec,
    PartitionColumn,
    RunSetting,
    SourceSpec,
    TargetSpec,
    job_from_dict,
    load_job_file,
    load_jobs_dir,
)

__all__ = [
    "ErrorLimit",
    "JobSpec",
    "PartitionColumn",
    "RunSetting",
    "SourceSpec",
    "TargetSpec",
    "job_from_dict",
    "load_job_file",
    "load_jobs_dir",
]
