"""Records of delimited text whose quoted fields hold line breaks, read in many tasks from one file.

A line break ends a record only if an even number of quotes stands before it in the file: a doubled
quote inside a field adds two. So lines are read by Spark's splittable text reader, each block of a
file sums its quotes, and the sums of the blocks before tell whether a block starts inside a field.
A running sum within the block then numbers the records, and the lines of a record are joined again.

The place of a line is its block's place in the file and its number within the block; blocks are the
scan's own splits, so nothing is moved to find the order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partload.functions.text import QUOTE
from partload.sources import storage

RECORD = "record"


_SPLIT = "spark.sql.files.maxPartitionBytes"


def numbered_lines(
    spark: SparkSession, paths: str | Sequence[str], split_bytes: int | None = None
) -> DataFrame:
    """(file, block, at, line, quotes) of every line, written once; splits of `split_bytes`.

    `block` is where the split that holds the line starts in its file; `at` grows along the lines of one block.
    """
    read = spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths))
    lines = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Rows of a task are numbered as they are read; a split is read by one task, from its start.
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
        (F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))).alias("quotes"),
    )
    before = spark.conf.get(_SPLIT)
    if split_bytes:
        spark.conf.set(_SPLIT, str(split_bytes))
    try:
        return storage.materialise(lines, "lines")
    finally:
        spark.conf.set(_SPLIT, before)


def open_blocks(lines: DataFrame) -> DataFrame:
    """(file, block, inside): whether a block starts within a quoted field.

    One row for each block is what the window sees, each file's on their own.
    """
    sums = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    return sums.select("file", "block", inside.alias("inside"))


def whole_records(lines: DataFrame) -> DataFrame:
    """(record): the text of every record, its inner line breaks kept.

    Lines are shuffled by block, never by file. A record that runs over the end of a block is put
    together from what its blocks hold of it.
    """
    blocks = storage.materialise(open_blocks(lines), "blocks")
    inner = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    # Quotes before the line, modulo 2, say whether the line goes on with a record.
    before = F.col("inside") + F.coalesce(F.sum("quotes").over(inner), F.lit(0))
    marked = lines.join(blocks, ["file", "block"]).withColumn("starts", (before % 2 == 0).cast("int"))
    upto = Window.partitionBy("file", "block").orderBy("at")
    numbered = marked.withColumn("number", F.sum("starts").over(upto))
    parts = numbered.groupBy("file", "block", "number").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n"
        ).alias("text")
    )
    parts = storage.materialise(parts, "parts")
    # Part 0 of a block is the rest of a record that began in an earlier one: the last that has a start.
    heads = parts.where("number = 0").select("file", "block", "text")
    begun = parts.where("number > 0").groupBy("file", "block").agg(F.max("number").alias("last"))
    # A few rows for each block: which block holds the start of the record a head goes on with.
    seen = parts.select("file", "block").distinct().join(begun, ["file", "block"], "left")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.max(F.when(F.col("last").isNotNull(), F.struct("block", "last"))).over(earlier)
    owner = seen.select("file", "block", start.alias("start")).where("start IS NOT NULL")
    tails = heads.join(owner, ["file", "block"]).groupBy(
        "file", F.col("start.block").alias("block"), F.col("start.last").alias("number")
    ).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "\n"
        ).alias("tail")
    )
    whole = parts.where("number > 0").join(tails, ["file", "block", "number"], "left")
    return whole.select(F.concat_ws("\n", "text", "tail").alias(RECORD))
