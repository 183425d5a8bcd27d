"""What several corpus operators share: words and hashes of Arrow text, row order, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partload.sources import storage

# Fixed by the contract: a word is a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

_U = np.uint64
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that near inputs get unrelated outputs."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_LOWER_BYTE = _BYTE.copy()
_LOWER_BYTE[65:91] = _BYTE[97:123]
_BASE = 0x5851F42D4C957F2D
_powers = [np.ones(1, dtype=_U), np.ones(1, dtype=_U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, dtype=_U)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=_U)
    return _powers[0][:n], _powers[1][:n]


def running_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which `span_hash` gets the hash of any span of 64-bit values."""
    out = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(values * powers(max(len(values), 1))[0][: len(values)], dtype=_U, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of values[start:end]; equal sequences get equal hashes wherever they stand."""
    inverse = powers(len(prefix))[1]
    return mix64((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(_U))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    if where is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(where, dtype=kind)[column.offset : column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    offsets = offsets.astype(np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_values(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """A random-looking 64-bit value for each byte; with `lower`, A-Z like a-z."""
    return (_LOWER_BYTE if lower else _BYTE)[data]


class HashIndex:
    """A hash table from 64-bit keys to numbers from 0, looked up and filled by whole arrays."""

    def __init__(self, bits: int = 16):
        self.bits, self.size = bits, 0
        self.keys = np.zeros(1 << bits, dtype=_U)
        self.values = np.full(1 << bits, -1, dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where there is none."""
        slot = self._slot(keys)
        out = self.values[slot]
        todo = np.flatnonzero((self.keys[slot] != keys) & (out >= 0))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            out[todo] = self.values[slot]
            miss = (self.keys[slot] != keys[todo]) & (out[todo] >= 0)
            todo, slot = todo[miss], slot[miss]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not in the table yet; it stays at most half full."""
        self.size += len(keys)
        if 2 * self.size > len(self.keys):
            used = self.values >= 0
            keys = np.concatenate([self.keys[used], keys])
            values = np.concatenate([self.values[used], values])
            self.bits = int(2 * self.size).bit_length()
            self.keys = np.zeros(1 << self.bits, dtype=_U)
            self.values = np.full(1 << self.bits, -1, dtype=np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.values[slot] < 0
            self.values[slot[free]] = values[left[free]]
            self.keys[slot[free]] = keys[left[free]]
            lost = self.keys[slot] != keys[left]
            left, slot = left[lost], (slot[lost] + 1) & ((1 << self.bits) - 1)


class Words:
    """The words of a slice of texts: byte span, 64-bit hash, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        word = ~_SEPARATOR[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.concatenate([[False], word[:-1]]) if len(word) else word
        after = np.concatenate([word[1:], [False]]) if len(word) else word
        self.start = np.flatnonzero(word & (~before | edge[:-1]))
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash = span_hash(running_hash(byte_values(data, lower)), self.start, self.end)


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of about `limit` bytes of text; a longer text is one part."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def fingerprint(text: str = "text") -> Column:
    """64 bits that tell rows of one id apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def spread(n_rows: int, per_group: int) -> int:
    """How many groups of about `per_group` rows hold n rows."""
    return max(1, -(-n_rows // per_group))


def running_total(
    df: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, name: str
) -> DataFrame:
    """Adds `name`: the sum of `value` over a key's earlier rows, by bucket and then by order.

    Rows of one key are summed bucket by bucket, so a key with a third of all rows is shared out
    over as many tasks as it has buckets. `order` must tell the rows of a bucket apart.
    """
    totals = df.groupBy(*keys, bucket).agg(F.sum(value).alias("_total"))
    ahead = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col(bucket).alias("_bucket"),
        F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_ahead"),
    )
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    same = F.col(bucket) == F.col("_bucket")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return (
        df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(totals, same)
        .withColumn(name, F.col("_ahead") + F.col("_inside"))
        .drop("_inside", "_ahead", "_bucket", *[f"_key_{k}" for k in keys])
    )


def dense_index(df: DataFrame, order: list[str], name: str, per_task: int = 100_000) -> DataFrame:
    """Adds `name`: the place (from 0) of each row in the order of `order`, nulls first.

    The rows are dealt by ranges and numbered within their task; the counts of the ranges before
    are added. The table is written once, so that a repeated task cannot number it differently.
    """
    spark = df.sparkSession
    tasks = max(spread(df.count(), per_task), spark.sparkContext.defaultParallelism)
    ranged = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    ranged = storage.materialise(ranged.withColumn("_id", F.monotonically_increasing_id()), "order")
    task = F.shiftright("_id", 33)
    counts = ranged.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    ahead = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range.
    counts = counts.withColumn("_ahead", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)))
    place = F.col("_ahead") + F.col("_id") - F.shiftleft(F.col("_task"), 33)
    return (
        ranged.withColumn("_of", task)
        .join(counts, F.col("_of") == F.col("_task"))
        .withColumn(name, place)
        .drop("_of", "_task", "_rows", "_ahead", "_id")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node of the edges (a, b) is connected with.

    Alternating large-star and small-star steps. Each joins the links of a node with the smallest
    of its neighbours, found by a partial minimum, and writes the links it leaves to the shared
    scratch folder, so no neighbour list is ever gathered and a lost executor costs one step.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, large: bool) -> DataFrame:
        """Links of each node a to those neighbours b that are to hang on its smallest one."""
        links = both(e) if large else e.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        )
        low = links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        out = links.join(low, "a")
        out = out.where("b > a") if large else out
        kept = out.select(F.col("b").alias("a"), F.col("low").alias("b"))
        if not large:
            kept = kept.union(low.select("a", F.col("low").alias("b")))
        return kept.where("a <> b").distinct()

    def settled(e: DataFrame) -> bool:
        """Whether every node links with one smaller node only, which itself links with no smaller one:
        steps then change nothing."""
        ends = e.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.union(e.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return sums.where("up > 1 OR up + down > 1").isEmpty()

    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = storage.materialise(current.distinct(), "links")
    while not settled(current):
        # Each step is stored: both of its joins then read a table, and the driver plans few nodes at once.
        current = storage.materialise(star(current, True), "links")
        current = storage.materialise(star(current, False), "links")
    roots = current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return roots.union(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def plain_names(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The columns in their places; all but those to keep get names that no operator uses itself."""
    return df.toDF(*[c if c in keep else f"other_{i}" for i, c in enumerate(df.columns)])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(name: str, value: str, body: str) -> str:
    """SQL of `body` with `name` standing for `value`, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"
