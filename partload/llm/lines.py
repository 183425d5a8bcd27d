"""Repeated lines by two Bloom filters, for keys seen once and keys seen twice, and an exact check.

Every line's key is reduced to a digest, which is written once. Filters are dealt by hash range, so
that they grow with the corpus while a task holds only its share: the first time a key comes by it is
entered in the filter of once-seen keys, and a key which that filter already knows is entered in the
filter of twice-seen keys. Neither filter forgets a key, so keys outside the second one occur once and
go no further. Only the others, the suspected repeats, are shuffled by digest, where the documents of
each are compared exactly and the smallest keeps its lines.

Filters are blocked: a key sets `probes` bits of one 64-bit word. The twice-seen words are a table;
its real size decides whether a join with it is broadcast or shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partload.llm.common import fingerprint, slices, spread
from partload.sources import storage

_U = np.uint64
_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)


@dataclass(frozen=True)
class LineParams:
    """`shortest`: code points of the shortest key that counts. `bits`: filter bits for each key;
    `probes`: bits a key sets; `per_shard`: keys whose filters a task holds at a time."""

    shortest: int = 10
    bits: int = 16
    probes: int = 4
    per_shard: int = 4_000_000


def _keys(params: LineParams) -> Column:
    """Digests of the distinct keys of a text that are long enough."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    key = F.transform(lines, lambda x: F.translate(F.btrim(x, F.lit(_SPACE)), _UPPER, _LOWER))
    long = F.filter(key, lambda x: F.length(x) >= params.shortest)
    return F.transform(F.array_distinct(long), lambda x: F.unhex(F.md5(x)))


def _word(h: Column, words: int) -> Column:
    """The filter word of a key: words is a power of two."""
    return F.shiftrightunsigned(h, 24).bitwiseAND(F.lit(words - 1))


def _mask(h: Column, probes: int) -> Column:
    """The bits of a word that a key sets, from the lowest bits of its hash."""
    out = F.lit(0).cast("long")
    for i in range(probes):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return out


def _filters(params: LineParams, words: int, shards: int):
    """Twice-seen words of the hashes of a task, which are all those of its shards."""
    size = words // shards

    def masks(h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), dtype=_U)
        for i in range(params.probes):
            out |= _U(1) << ((h >> _U(6 * i)) & _U(63))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            h, n = np.unique(batch.column("h").to_numpy().view(_U), return_counts=True)
            mask, word = masks(h), (h >> _U(24)) & _U(words - 1)
            shard, place = (word // _U(size)).astype(np.int64), (word % _U(size)).astype(np.int64)
            for s in np.unique(shard):
                once, twice = held.setdefault(s, (np.zeros(size, _U), np.zeros(size, _U)))
                at = np.flatnonzero(shard == s)
                p, m = place[at], mask[at]
                # Keys of one batch that share a word do not see each other, so equal ones count here.
                known = ((once[p] & m) == m) | (n[at] > 1)
                np.bitwise_or.at(twice, p[known], m[known])
                np.bitwise_or.at(once, p, m)
        for s, (_, twice) in held.items():
            at = np.flatnonzero(twice)
            for low in range(0, len(at), 1 << 16):
                part = at[low : low + (1 << 16)]
                yield pa.record_batch(
                    {"word": pa.array(part + s * size, pa.int64()), "bits": pa.array(twice[part].view(np.int64))}
                )

    return run


def twice_seen(keys: DataFrame, params: LineParams) -> tuple[DataFrame, int]:
    """(word, bits) of the filter of twice-seen keys of a stored table with hashes h, and its words."""
    n = keys.count()
    words = 1 << max(16, (n * params.bits // 64 - 1).bit_length())
    tasks = max(spread(n, params.per_shard), keys.sparkSession.sparkContext.defaultParallelism)
    shards = 1 << (tasks - 1).bit_length()
    number = (_word(F.col("h"), words) / F.lit(words // shards)).cast("int")
    dealt = keys.select("h").repartitionById(shards, number)
    found = dealt.mapInArrow(_filters(params, words, shards), "word long, bits long")
    return storage.materialise(found, "twice"), words


def repeated_keys(docs: DataFrame, params: LineParams) -> DataFrame:
    """(doc_id, fp, digest) of the keys that a row must lose."""
    keys = docs.select("doc_id", fingerprint().alias("fp"), F.explode(_keys(params)).alias("digest"))
    keys = storage.materialise(keys.withColumn("h", F.xxhash64("digest")), "keys")
    filters, words = twice_seen(keys, params)
    known = F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask")
    suspects = (
        keys.withColumn("word", _word(F.col("h"), words)).withColumn("_mask", _mask(F.col("h"), params.probes))
        .join(filters, "word").where(known).select("doc_id", "fp", "digest")
    )
    suspects = storage.materialise(suspects, "suspects")
    # Null ids are one document behind all others; min and max differ where two documents do.
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    first = suspects.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = storage.materialise(first.where("first <> last").select("digest", "first"), "first")
    return suspects.join(first, "digest").where(place != F.col("first")).select("doc_id", "fp", "digest")


def _cut(params: LineParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lines, dropped, kept = [], [], []
                for text, gone in zip(part.column("text").to_pylist(), part.column("gone").to_pylist(), strict=True):
                    text = text or ""
                    lines.append(text.count("\n") + 1)
                    if not gone:
                        dropped.append(0)
                        kept.append(text)
                        continue
                    gone, stay = set(gone), []
                    for line in text.split("\n"):
                        key = line.strip(_SPACE).translate(_FOLD)
                        if len(key) < params.shortest or hashlib.md5(key.encode()).digest() not in gone:
                            stay.append(line)
                    dropped.append(lines[-1] - len(stay))
                    kept.append("\n".join(stay))
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_lines": pa.array(lines, pa.int64()),
                        "n_dropped": pa.array(dropped, pa.int64()),
                        "kept_text": pa.array(kept, pa.string()),
                    }
                )

    return run


def drop_repeated_lines(docs: DataFrame, params: LineParams = LineParams()) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text), one row for each row of docs.

    A text is split at line feeds; a null or empty text is one empty line. A line's key is the line
    without white space at its ends and with A-Z lowered. Keys of at least `shortest` code points
    that occur in two documents or more lose all their lines but those of the smallest doc_id; a
    repeat within one document is none. Rows that share a doc_id are one document, and so are all
    rows without one, which comes after all others. Other columns of docs are not looked at.

    Keys are told apart by MD5, never by a filter alone. A row's digests are gathered by (doc_id, fp),
    so copies of one row bring one list, bounded by the lines of the text.
    """
    rows = docs.select("doc_id", "text").withColumn("fp", fingerprint())
    gone = repeated_keys(rows.select("doc_id", "text"), params).distinct()
    gone = storage.materialise(gone.groupBy("doc_id", "fp").agg(F.collect_list("digest").alias("gone")), "gone")
    gone = gone.withColumnsRenamed({"doc_id": "_doc", "fp": "_fp"})
    same = rows["doc_id"].eqNullSafe(gone["_doc"]) & (rows["fp"] == gone["_fp"])
    return rows.join(gone, same, "left").select("doc_id", "text", "gone").mapInArrow(
        _cut(params), "doc_id long, n_lines long, n_dropped long, kept_text string"
    )
