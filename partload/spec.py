"""Job configuration. Plain values only; nothing here touches data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

DATE_COLUMN = "processing_date"

# The file formats a target may have. "text" is delimited text.
FILE_FORMATS = ("text", "orc", "parquet")

# How a load is laid out before it is written.
#   rebalance  cluster rows by partition value in one shuffle; hot values are split by AQE
#   asis       keep the input tasks, no shuffle; every task writes a file per value it meets
LAYOUTS = ("rebalance", "asis")


@dataclass(frozen=True)
class PartitionColumn:
    column: str
    dynamic: bool = False


@dataclass(frozen=True)
class ErrorLimit:
    """Bad rows a load may have. `record` decides; `percentage` counts only if record is None."""

    record: int | None = 0
    percentage: float = 0.0

    def allows(self, bad: int, total: int) -> bool:
        return bad <= (self.record if self.record is not None else total * self.percentage)


@dataclass(frozen=True)
class RunSetting:
    """How a load is written.

    `values_per_batch` writes partition values in groups, each with its own filtered scan, so that
    a failed load resumes at a group; use it where sources can skip data by partition value.
    `files_per_partition` asks for exactly that many files in every partition with rows enough; a
    file then is as large as the partition makes it, unless max_records_per_file cuts it.
    """

    error_limit: ErrorLimit = field(default_factory=ErrorLimit)
    files_per_partition: int | None = None
    max_records_per_file: int = 0
    values_per_batch: int | None = None
    layout: str = "rebalance"

    def __post_init__(self):
        if self.layout not in LAYOUTS:
            raise ValueError(f"layout must be one of {LAYOUTS}, got {self.layout!r}")
        if self.values_per_batch is not None and self.values_per_batch < 1:
            raise ValueError("values_per_batch must be at least 1")


@dataclass(frozen=True)
class SourceSpec:
    owner: str
    load_tables: tuple[str, ...]
    columns: tuple[str, ...]

    def __post_init__(self):
        if not self.load_tables:
            raise ValueError("a job needs at least one load table")
        if not self.columns:
            raise ValueError("a job needs at least one column")


@dataclass(frozen=True)
class TargetSpec:
    """Where rows land. `root` is a file-system prefix kept as given; `base_dir` is lowercased."""

    owner: str
    table: str
    base_dir: str
    file_format: str = "parquet"
    partitions: tuple[PartitionColumn, ...] = ()
    root: str = ""

    def __post_init__(self):
        if self.file_format not in FILE_FORMATS:
            raise ValueError(f"file format must be one of {FILE_FORMATS}, got {self.file_format!r}")
        object.__setattr__(self, "base_dir", self.base_dir.lower())

    @property
    def location(self) -> str:
        if not self.root:
            return self.base_dir
        return f"{self.root.rstrip('/')}/{self.base_dir.strip('/')}"

    @property
    def dynamic_columns(self) -> tuple[str, ...]:
        return tuple(p.column for p in self.partitions if p.dynamic)

    @property
    def static_columns(self) -> tuple[str, ...]:
        return tuple(p.column for p in self.partitions if not p.dynamic)

    @property
    def partition_columns(self) -> tuple[str, ...]:
        return (DATE_COLUMN, *self.dynamic_columns)

    @property
    def full_name(self) -> str:
        return f"{self.owner}.{self.table}" if self.owner else self.table


@dataclass(frozen=True)
class JobSpec:
    table_name: str
    source: SourceSpec
    target: TargetSpec
    loader: str = "spark"
    setting: RunSetting = field(default_factory=RunSetting)
    retention_days: int | None = None
    enabled: bool = True
    # Typing: compat maps everything to double, bigint or string; preserve keeps native types.
    preserve_types: bool = False
    strict_types: bool = False
    # An empty string and NULL are one value in the target unless this is off.
    empty_as_null: bool = True
    # Replace the whole processing date, not only the partition values of this run.
    replace_date: bool = False

    def __post_init__(self):
        names = {c.lower() for c in self.source.columns}
        for column in self.target.dynamic_columns:
            if column.lower() not in names:
                raise ValueError(f"dynamic partition column {column} is not among the job's columns")

    @property
    def runnable(self) -> bool:
        return self.enabled and not self.loader.startswith("legacy_")


def _section(raw: Mapping, key: str) -> Mapping:
    """The mapping holding `owner`: the section itself or one named block inside it."""
    section = raw[key]
    if "owner" in section:
        return section
    for value in section.values():
        if isinstance(value, Mapping) and "owner" in value:
            return value
    raise ValueError(f"{key}: no owner given")


def job_from_dict(raw: Mapping, default_name: str = "", root: str = "") -> JobSpec:
    """Build a JobSpec from a parsed job file. The column list must sit under `source.columns`."""
    source, target = raw["source"], raw["target"]
    source_owner, target_owner = _section(raw, "source"), _section(raw, "target")
    if "columns" not in source:
        raise ValueError("source.columns is missing")
    base_dir = target.get("base_dir") or target.get("obs_dir")
    if base_dir is None:
        raise ValueError("target.base_dir is missing")
    setting = raw.get("setting") or {}
    limit = setting.get("error_limit") or {}
    return JobSpec(
        table_name=raw.get("table_name") or default_name,
        source=SourceSpec(
            owner=source_owner["owner"],
            load_tables=tuple(source_owner["load_tables"]),
            columns=tuple(source["columns"]),
        ),
        target=TargetSpec(
            owner=target_owner["owner"],
            table=target_owner["table"],
            base_dir=base_dir,
            file_format=target.get("format", "parquet"),
            partitions=tuple(
                PartitionColumn(p["column"], bool(p.get("dynamic", False)))
                for p in target.get("partitions") or ()
            ),
            root=root or target.get("root", ""),
        ),
        loader=raw.get("loader", "spark"),
        setting=RunSetting(
            error_limit=ErrorLimit(limit.get("record", 0), limit.get("percentage", 0.0)),
            files_per_partition=setting.get("speed_channel") or setting.get("files_per_partition"),
            max_records_per_file=setting.get("max_records_per_file", 0),
            values_per_batch=setting.get("values_per_batch"),
            layout=setting.get("layout", "rebalance"),
        ),
        retention_days=raw.get("retention_days"),
        enabled=raw.get("enabled", True),
        preserve_types=raw.get("preserve_types", False),
        strict_types=raw.get("strict_types", False),
        empty_as_null=raw.get("empty_as_null", True),
        replace_date=raw.get("replace_date", False),
    )


def load_job_file(path: str | Path, root: str = "") -> JobSpec:
    import yaml

    path = Path(path)
    return job_from_dict(yaml.safe_load(path.read_text()), default_name=path.stem, root=root)


def load_jobs_dir(path: str | Path, root: str = "") -> list[JobSpec]:
    return [load_job_file(p, root) for p in sorted(Path(path).glob("*.yaml"))]
