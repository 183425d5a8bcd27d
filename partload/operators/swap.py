"""Replacing partitions only after the load was judged: stage, judge, swap.

A load writes its partitions to a hidden folder beside the target. What is visible changes only when
the caller publishes: a journal names every partition to replace or remove, and each is swapped by
two renames, the old one out and the new one in. Old partitions stay in the hidden folder until all
are swapped. A load that dies before its journal is complete has changed nothing; one that dies after
it is rolled forward by `recover`, which may be repeated and may itself die.

Only directory names pass the driver, as in Spark's own commit of a partitioned overwrite.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from partload.functions.keys import escape_value
from partload.sources import storage

# Hidden from Spark's listing of a table's files.
FOLDER = "_loads"
_JOURNAL = "journal"
_PUT, _DROP = "+", "-"


class Staged:
    """One load's hidden folder: `new` holds staged partitions, `old` what they replaced."""

    def __init__(self, spark: SparkSession, location: str, folder: str):
        self.spark, self.location = spark, location.rstrip("/")
        self.path = f"{self.location}/{FOLDER}/{folder}"
        self.new, self.old = f"{self.path}/new", f"{self.path}/old"

    def partitions(self, depth: int) -> list[str]:
        """Relative paths of the staged partition folders, `depth` levels down."""
        plain = re.sub(r"([\\{}\[\]*?])", r"\\\1", self.new)
        found = storage.glob(self.spark, plain + "/*=*" * depth)
        # The file system may add a scheme to a path; its last levels are the partition's.
        return sorted("/".join(p.split("/")[-depth:]) for p in found)

    def discard(self) -> None:
        """Forget the load; nothing visible has changed."""
        storage.delete_prefix(self.spark, self.path)
        for folder in (self.path.rsplit("/", 1)[0], f"{self.location}/{FOLDER}"):
            storage.delete_empty_dir(self.spark, folder)

    def publish(self, put: Sequence[str], drop: Sequence[str] = ()) -> None:
        """Replace the partitions `put` by the staged ones, and remove the partitions `drop`.

        From the moment the journal has its name the swap will be completed, by this call or by
        `recover`.
        """
        lines = [*(_PUT + p for p in put), *(_DROP + p for p in drop)]
        if not lines:
            return self.discard()
        draft = f"{self.path}/{_JOURNAL}.draft"
        storage.write_text(self.spark, draft, "\n".join(lines))
        storage.move(self.spark, draft, f"{self.path}/{_JOURNAL}")
        self.roll_forward()

    def roll_forward(self) -> None:
        """Complete the swap the journal describes."""
        journal = f"{self.path}/{_JOURNAL}"
        lines = [x for x in storage.read_text(self.spark, journal).split("\n") if x]
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(self._swap, lines))
        # Without its journal the folder is only rubbish, however much of it a crash leaves.
        storage.delete_prefix(self.spark, journal)
        self.discard()

    def _swap(self, line: str) -> None:
        live, new, old = (f"{base}/{line[1:]}" for base in (self.location, self.new, self.old))
        if line[0] == _PUT and not storage.exists(self.spark, new):
            return
        if storage.exists(self.spark, live) and not storage.exists(self.spark, old):
            storage.move(self.spark, live, old)
        if line[0] == _PUT:
            # What stands there although the old one is out is a foreign writer's.
            storage.delete_prefix(self.spark, live)
            storage.move(self.spark, new, live)


def begin(spark: SparkSession, location: str, processing_date: str) -> Staged:
    """A new hidden folder for one load of a date. Swaps of that date that were cut off come first."""
    recover(spark, location, processing_date)
    return Staged(spark, location, f"{escape_value(processing_date)}/{uuid.uuid4().hex}")


def _open(spark: SparkSession, location: str, processing_date: str | None) -> Iterable[Staged]:
    root = f"{location.rstrip('/')}/{FOLDER}"
    dates = storage.list_dirs(spark, root) if processing_date is None else [escape_value(processing_date)]
    for date in dates:
        for name in storage.list_dirs(spark, f"{root}/{date}"):
            yield Staged(spark, location, f"{date}/{name}")


def recover(spark: SparkSession, location: str, processing_date: str | None = None) -> int:
    """Complete swaps that were cut off, of one date or of all; returns how many there were.

    Loads of other dates that are still being written have no journal yet and are left alone.
    """
    done = 0
    for staged in _open(spark, location, processing_date):
        if storage.exists(spark, f"{staged.path}/{_JOURNAL}"):
            staged.roll_forward()
            done += 1
    return done


def sweep(spark: SparkSession, location: str, processing_date: str) -> int:
    """Delete what dead loads of a date left behind unpublished; returns how many there were.

    Only for a date that no other load is writing.
    """
    recover(spark, location, processing_date)
    left = list(_open(spark, location, processing_date))
    for staged in left:
        staged.discard()
    return len(left)
