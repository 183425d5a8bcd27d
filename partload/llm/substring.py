"""Repeated passages by winnowed anchors: seed, extend both ways, keep maximal repeats.

An anchor is a short word gram whose hash is the smallest within a window of words, so two equal
windows choose anchors at the same place. The consecutive windows that chose one anchor are its
run; the run reaches from the first word of the first to the last word of the last of them.

1. Seed: documents meet on anchors. An anchor seen once repeats in no window.
2. Extend: occurrences of an anchor whose whole runs agree, on both sides of the seed, repeat in
   every window of the run. Each such class of runs is one row, however many occurrences it has.
3. Where an anchor has several classes, their runs agree on a part only. One occurrence of each
   class gives its windows, and those found in two classes repeat for all members of both.
4. Overlapping repeated windows of a document join to maximal repeats.

No occurrence is paired with another, and a passage in a third of all documents costs one partial
count per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partload.llm.common import Words, fingerprint, mix64, running_hash, slices, span_hash, text_bytes
from partload.sources import storage

_U = np.uint64
_MASK = (1 << 64) - 1


@dataclass(frozen=True)
class RepeatParams:
    """`window`: words of the shortest repeat; `gram`: words of an anchor, at most `window`."""

    window: int = 50
    gram: int = 8


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def _anchors(params: RepeatParams):
    size, gram = params.window, min(params.gram, params.window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(*text_bytes(part.column("text")))
                first, total = words.first, len(words.hash)
                if total < size:
                    continue
                prefix = running_hash(words.hash)
                at = np.arange(total - gram + 1)
                grams = span_hash(prefix, at, at + gram)
                # Ties go to the leftmost place, alike in equal windows.
                low = _U(max(1, int(total).bit_length()))
                ranked = (grams >> low << low) | at.astype(_U)
                chosen = _smallest(ranked, size - gram + 1) & ((_U(1) << low) - _U(1))
                chosen = chosen.astype(np.int64)
                start = np.arange(total - size + 1)
                doc = np.searchsorted(first, start, side="right") - 1
                inside = start + size <= first[doc + 1]
                start, doc, chosen = start[inside], doc[inside], chosen[inside]
                if not len(start):
                    continue
                new = np.ones(len(start), dtype=bool)
                new[1:] = (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(start)) - 1
                doc, chosen, a, b = doc[head], chosen[head], start[head], start[tail]
                # The place of the anchor in the run belongs to the class.
                run_hash = mix64(span_hash(prefix, a, b + size) + (chosen - a).astype(_U))
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id").take(pa.array(doc)),
                        "fp": part.column("fp").take(pa.array(doc)),
                        "anchor": pa.array(grams[chosen].view(np.int64)),
                        "run": pa.array(run_hash.view(np.int64)),
                        "first": pa.array((a - first[doc]).astype(np.int32)),
                        "windows": pa.array((b - a + 1).astype(np.int32)),
                        "seed": pa.array((chosen - a).astype(np.int32)),
                    }
                )

    return run


_ANCHOR_SCHEMA = "doc_id long, fp long, anchor long, run long, first int, windows int, seed int"


def _windows(params: RepeatParams):
    """Each window of the wanted runs: its distance to the anchor, and a hash of both and its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(*text_bytes(part.column("text")))
                prefix = running_hash(words.hash)
                out: dict[str, list] = {"anchor": [], "run": [], "offset": [], "hash": []}
                for i, runs in enumerate(part.column("runs").to_pylist()):
                    for r in runs:
                        at = np.arange(r["windows"])
                        begin = words.first[i] + r["first"] + at
                        offset = (r["seed"] - at).astype(np.int64)
                        place = mix64(_U(r["anchor"] & _MASK) + offset.astype(_U))
                        out["hash"].append(mix64(span_hash(prefix, begin, begin + params.window) + place))
                        out["offset"].append(offset)
                        out["anchor"].append(np.full(len(at), r["anchor"], np.int64))
                        out["run"].append(np.full(len(at), r["run"], np.int64))
                if out["hash"]:
                    joined = {k: np.concatenate(v) for k, v in out.items()}
                    joined["hash"] = joined["hash"].view(np.int64)
                    joined["offset"] = joined["offset"].astype(np.int32)
                    yield pa.record_batch({k: pa.array(v) for k, v in joined.items()})

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "text", fingerprint().alias("fp"))


def repeats(docs: DataFrame, params: RepeatParams) -> DataFrame:
    """(doc_id, fp, spans): the repeated word spans of the documents that have any.

    A span is a row of consecutive repeated windows: the first word times 2**32, plus their number.
    """
    keyed = _keyed(docs)
    # Written, because both the count and the join below read them: texts are hashed once.
    anchors = storage.materialise(keyed.mapInArrow(_anchors(params), _ANCHOR_SCHEMA), "anchors")
    seeds = anchors.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("_n"), F.min("run").alias("_low"), F.max("run").alias("_high")
    )
    seeds = seeds.where("_n > 1").select("anchor", F.expr("_low <> _high").alias("several"))
    seeds = storage.materialise(seeds, "seeds")
    repeated = storage.materialise(anchors.join(seeds, "anchor"), "repeated")
    # All runs of these anchors agree.
    whole = F.array(_packed("first", "windows"))
    alike = repeated.where("NOT several").select("doc_id", "fp", whole.alias("part"))

    several = repeated.where("several")
    classes = several.groupBy("anchor", "run").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("doc_id", "fp", "first", "windows", "seed")).alias("one"),
    )
    classes = storage.materialise(classes, "classes")
    wanted = classes.select("anchor", "run", "one.*").groupBy("doc_id", "fp").agg(
        F.collect_list(F.struct("anchor", "run", "first", "windows", "seed")).alias("runs")
    )
    # Rows that repeat one document give the same windows; a window counts once for each class.
    windows = keyed.join(wanted, ["doc_id", "fp"]).select("text", "runs").mapInArrow(
        _windows(params), "anchor long, run long, offset int, hash long"
    )
    windows = storage.materialise(windows, "windows")
    common = windows.groupBy("hash").agg(F.min("run").alias("_low"), F.max("run").alias("_high"))
    common = common.where("_low <> _high").select("hash")
    partly = windows.join(common, "hash", "left_semi").groupBy("anchor", "run").agg(
        F.collect_set("offset").alias("offsets")
    )
    decided = (
        classes.select("anchor", "run", "n")
        .join(partly, ["anchor", "run"], "left")
        .where("n > 1 OR offsets IS NOT NULL")
        .select("anchor", "run", (F.col("n") > 1).alias("every"), "offsets")
    )
    # Written, so that the join below is between two exchanges and AQE can split a hot passage.
    decided = storage.materialise(decided, "decided")
    parts = F.transform("offsets", lambda o: _packed(F.col("first") + F.col("seed") - o, F.lit(1)))
    differ = several.join(decided, ["anchor", "run"]).select(
        "doc_id", "fp", F.when(F.col("every"), whole).otherwise(parts).alias("part")
    )
    # Rows that repeat one document have the same parts, of which one is kept.
    return (
        alike.union(differ).groupBy("doc_id", "fp").agg(F.flatten(F.collect_set("part")).alias("spans"))
    )


def _packed(start: Column | str, windows: Column | str) -> Column:
    start = F.col(start) if isinstance(start, str) else start
    windows = F.col(windows) if isinstance(windows, str) else windows
    return F.shiftleft(start.cast("long"), 32) + windows.cast("long")


def _covered(spans: np.ndarray, n_words: int, size: int) -> np.ndarray:
    """Which words a repeated window covers."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    start = spans >> 32
    end = start + (spans & 0xFFFFFFFF) - 1 + size
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(params: RepeatParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                words = Words(data, offsets)
                raw = data.tobytes()
                kept, removed, maximal = [], [], []
                for i, found in enumerate(part.column("spans")):
                    spans = found.values.to_numpy() if found.is_valid else np.zeros(0, np.int64)
                    a, b = words.first[i], words.first[i + 1]
                    start, end = words.start[a:b], words.end[a:b]
                    out = _covered(spans, b - a, params.window)
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], out.astype(np.int8), [0]])))
                    maximal.append([{"start": s, "end": e} for s, e in edges.reshape(-1, 2).tolist()])
                    removed.append(int(out.sum()))
                    if not len(out):
                        kept.append(b"")
                    elif removed[-1]:
                        left = np.flatnonzero(~out)
                        kept.append(b" ".join(
                            raw[s:e] for s, e in zip(start[left].tolist(), end[left].tolist(), strict=True)
                        ))
                    else:
                        kept.append(b" ".join(raw[offsets[i] : offsets[i + 1]].split(None)))
                yield pa.record_batch(
                    {
                        "doc_id": part.column("id"),
                        "n_words": pa.array(np.diff(words.first).astype(np.int64)),
                        "n_removed": pa.array(removed, pa.int64()),
                        "kept_text": pa.array([k.decode() for k in kept], pa.string()),
                        "repeats": pa.array(
                            maximal, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                        ),
                        "fp": part.column("fp"),
                    }
                )

    return run


def remove_repeats(docs: DataFrame, params: RepeatParams = RepeatParams()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, repeats, fp), one row for each row of docs.

    Every occurrence of a repeated window is removed, the first one too; what is left is the other
    words joined by single spaces. `repeats` are the maximal repeats as word spans [start, end).
    Null text has no words; texts of fewer words than a window keep all. Rows that repeat a
    document are occurrences of their own. Other columns of docs are not looked at.
    """
    spans = repeats(docs, params)
    keyed = docs.select(
        F.col("doc_id").alias("id"), F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "text",
        fingerprint().alias("fp"),
    )
    joined = keyed.join(spans, ["doc_id", "fp"], "left").select("id", "text", "fp", "spans")
    return joined.mapInArrow(
        _cut(params),
        "doc_id long, n_words long, n_removed long, kept_text string, "
        "repeats array<struct<start: long, end: long>>, fp long",
    )
