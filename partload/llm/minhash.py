"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set are its distinct word shingles. Its sketch has t coordinates, filled in rounds:
round i < t throws every element into a hashed bin with a hashed value in [i, i + 1); round t + j
throws every element into bin j. A coordinate keeps its smallest value, and rounds end when no bin
is empty. The last t rounds fill every bin of any non-empty set; a set of more than about t log t
elements is done after the first rounds. Coordinates of two sketches agree with the probability of
their sets' Jaccard similarity, and the mean over coordinates is concentrated like independent ones.

Sketches are cut into bands; documents that share a band become candidates and are linked only if
their full sets pass the exact test. Equal sets form one class whose smallest id stands for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partload.llm.common import Words, components, mix64, running_hash, slices, span_hash, text_bytes
from partload.sources import storage

_U = np.uint64


@dataclass(frozen=True)
class NearParams:
    """`percent`: links need 100 * intersection >= percent * union.

    24 bands of 5 coordinates miss a pair of similarity 0.8 with probability 7e-5, and one of
    0.85 with 8e-7. `block` and `members`: shingles and documents a task compares with
    others at once.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 24
    rows: int = 5
    lower: bool = True
    block: int = 200_000
    members: int = 2_000


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    prefix = running_hash(words.hash)
    count = np.diff(words.first)
    for first, n in zip(words.first[:-1], count, strict=True):
        if n == 0:
            yield np.zeros(0, _U)
            continue
        start = np.arange(first, first + max(n - k + 1, 1))
        yield np.unique(span_hash(prefix, start, start + min(k, n)))


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """One row of t coordinates for each non-empty set; coordinates hold round and hash."""
    out = np.full((len(sets), t), np.iinfo(_U).max, dtype=_U)
    flat = out.reshape(-1)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    items = np.concatenate(sets) if sets else np.zeros(0, _U)
    for i in range(2 * t):
        if not len(items):
            break
        value = mix64(items + _U((2 * i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        place = mix64(value ^ _U(0xD1B54A32D192ED03)) % _U(t) if i < t else _U(i - t)
        at = owner * t + place.astype(np.int64)
        np.minimum.at(flat, at, (_U(i) << _U(52)) | (value >> _U(12)))
        if i >= t - 1 or i < 16 or i % 8 == 0:
            open_ = (out == np.iinfo(_U).max).any(axis=1)
            more = open_[owner]
            items, owner = items[more], owner[more]
    return out


def _sketched(params: NearParams):
    t = params.bands * params.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(*text_bytes(part.column("text")), lower=params.lower)
                sets = list(shingle_sets(words, params.shingle))
                sketch = sketches(sets, t)
                mini = (mix64(sketch) >> _U(56)).astype(np.uint8)
                sketch = sketch.reshape(len(sets), params.bands, params.rows)
                band = np.zeros((len(sets), params.bands), _U)
                for j in range(params.rows):
                    band = mix64(band * _U(31) + sketch[:, :, j])
                band = mix64(band + np.arange(params.bands, dtype=_U)[None, :])
                digest = [
                    [int(x) for x in (s.sum(dtype=_U), mix64(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U))]
                    for s in sets
                ]
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "digest": pa.array(
                            [f"{a:016x}{b:016x}" if len(s) else None
                             for (a, b), s in zip(digest, sets, strict=True)],
                            pa.string(),
                        ),
                        # One byte of each coordinate; a set without elements has no sketch.
                        "mini": pa.array(
                            [m.tobytes() if len(s) else None for m, s in zip(mini, sets, strict=True)], pa.binary()
                        ),
                        "bands": pa.array(
                            [b.view(np.int64) if len(s) else [] for b, s in zip(band, sets, strict=True)],
                            pa.list_(pa.int64()),
                        ),
                    }
                )

    return run


def _likely(params: NearParams):
    """Pairs whose sketches agree in no less than `percent` - 25 of 100 coordinates."""
    t = params.bands * params.rows
    least = t * (params.percent - 25) // 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8).reshape(-1, t)
                for c in ("mini_a", "mini_b")
            )
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    return run


def _tested(params: NearParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=_U) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                passed.append(100 * both >= params.percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))

    return run


def _sets(params: NearParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(*text_bytes(part.column("text")), lower=params.lower)
                sets = [s.tobytes() for s in shingle_sets(words, params.shingle)]
                yield pa.record_batch(
                    {"rep": part.column("doc_id"), "shingles": pa.array(sets, pa.binary())}
                )

    return run


def candidate_sets(docs: DataFrame, reps: DataFrame, params: NearParams) -> DataFrame:
    """(rep, shingles): the full 64-bit shingle sets of those documents that are candidates at all.

    The one time that texts are shuffled; both exact tests read the sets.
    """
    chosen = docs.join(reps.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    sets = chosen.mapInArrow(_sets(params), "rep long, shingles binary")
    return storage.materialise(sets, "sets")


def verified(pairs: DataFrame, sets: DataFrame, params: NearParams) -> DataFrame:
    """Those pairs (a, b) whose full sets pass the test.

    Both joins read one exchange of the sets; only the set of a pair's first document moves again. A
    document that stands in very many pairs makes its key hot; AQE splits that side, and the other
    side has one row for each key.
    """
    first = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b"))
    return (
        pairs.join(first, "a").join(second, "b")
        .mapInArrow(_tested(params), "a long, b long")
        .distinct()
    )


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The intersection sizes of all sets in a with all sets in b, by products of 0/1 matrices."""
    sizes = [len(s) for s in a] + [len(s) for s in b]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, column, n = np.unique(np.concatenate(a + b), return_inverse=True, return_counts=True)
    shared = n[column] > 1
    owner, column = owner[shared], (np.cumsum(n > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    width = 2048
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        at = slice(*np.searchsorted(column, [low, low + width]))
        ones = np.zeros((len(sizes), width), dtype=np.float32)
        ones[owner[at], column[at] - low] = 1
        out += ones[: len(a)] @ ones[len(a) :].T
    return out


def _between(params: NearParams):
    """Links between the components of two blocks of a bucket, one for each row and component."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        block = table.column("block").to_numpy()
        left, right = np.flatnonzero(block == key[1].as_py()), np.flatnonzero(block == key[2].as_py())
        rep, component = table.column("rep").to_numpy(), table.column("component").to_numpy()
        sets = [np.frombuffer(x, dtype=_U) for x in table.column("shingles").to_pylist()]
        size = np.array([len(x) for x in sets])
        # Most members are of one component mostly, and need no comparison with each other.
        names, n = np.unique(component, return_counts=True)
        main = component == names[np.argmax(n)]
        found = []
        for a, b in ((left[~main[left]], right), (left[main[left]], right[~main[right]])):
            if not len(a) or not len(b):
                continue
            both = _common([sets[i] for i in a], [sets[i] for i in b])
            union = size[a][:, None] + size[b][None, :] - both
            differ = component[a][:, None] != component[b][None, :]
            i, j = np.nonzero((100 * both >= params.percent * union) & differ)
            _, first = np.unique(np.stack([i, component[b[j]]]), axis=1, return_index=True)
            found.append(np.stack([rep[a[i[first]]], rep[b[j[first]]]]))
        out = np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int64)
        return pa.table({"a": out[0], "b": out[1]})

    return run


def open_links(sets: DataFrame, entries: DataFrame, params: NearParams) -> DataFrame:
    """Links (a, b) between different components of a bucket: entries (bucket, rep, component, blocks).

    The members of a bucket are dealt to blocks of about `params.block` shingles and at most about
    `params.members` documents, and every two blocks meet in one task, so a large bucket is compared in
    many tasks of bounded size.
    """
    block = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = (
        entries.withColumn("block", block).withColumn("other", other)
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
        .select("bucket", "low", "high", "block", "rep", "component")
    )
    return (
        dealt.join(sets.distinct(), "rep")
        .groupBy("bucket", "low", "high")
        .applyInArrow(_between(params), "a long, b long")
        .distinct()
    )


def near_duplicates(docs: DataFrame, params: NearParams = NearParams()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of docs.

    Documents without words or text have no shingles and link with nothing. Rows that repeat a
    doc_id are one document: it links where one of its texts does. Rows with a null doc_id link
    with nothing, have a null component and are kept. Other columns of docs are not looked at.

    1. Documents of equal sets form a class (grouped by a 128-bit digest of the set).
    2. In every band bucket each class is compared with the bucket's smallest one. The number of
       pairs is at most the number of bucket entries. Pairs whose sketches agree far too rarely (by a
       quarter of all coordinates, which a pair that links does with a probability below 1e-8) go;
       the full sets of the others decide.
    3. Buckets whose classes are not all connected then are compared in full between components,
       block by block within tasks, so that no link that could join two components is lost and none
       of the pairs becomes a row.
    """
    rows = docs.select("doc_id", "text")
    sketched = storage.materialise(
        rows.mapInArrow(
            _sketched(params), "doc_id long, n_shingles long, digest string, mini binary, bands array<long>"
        ),
        "sketches",
    )
    named = sketched.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    # Written, so that joins with it are between two exchanges and AQE can split a hot class.
    classes = storage.materialise(
        named.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes"
    )
    member = named.join(classes, "digest").select("doc_id", "rep").distinct()
    chosen = named.join(classes, [named.digest == classes.digest, named.doc_id == classes.rep])
    entries = chosen.select(F.explode(F.array_distinct("bands")).alias("bucket"), "rep", "n_shingles").distinct()
    shared = entries.groupBy("bucket").agg(
        F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").drop("n")
    entries = storage.materialise(entries.join(shared, "bucket"), "entries")
    reps = storage.materialise(entries.select("rep").distinct(), "reps")
    minis = chosen.select("rep", F.col("n_shingles").alias("n"), "mini").distinct()
    minis = storage.materialise(minis.join(reps, "rep", "left_semi"), "minis")
    first = minis.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("mini").alias("mini_a"))
    second = minis.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("mini").alias("mini_b"))

    stars = entries.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    stars = stars.join(first, "a").join(second, "b").where(
        100 * F.least("n_a", "n_b") >= params.percent * F.greatest("n_a", "n_b")
    )
    stars = stars.select("a", "b", "mini_a", "mini_b").mapInArrow(_likely(params), "a long, b long")
    stars = storage.materialise(stars.distinct(), "stars")
    sets = candidate_sets(rows, reps, params)
    links = storage.materialise(verified(stars, sets, params), "links")
    found = storage.materialise(components(links), "components")

    # What stands in one bucket but in several components yet.
    placed = entries.join(found, entries.rep == found.node, "left").select(
        "bucket", "rep", "n_shingles", F.coalesce("component", "rep").alias("component")
    )
    mixed = placed.groupBy("bucket").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high"),
        F.ceil(
            F.greatest(F.sum("n_shingles") / params.block, F.count(F.lit(1)) / params.members)
        ).alias("blocks"),
    ).where("_low <> _high").select("bucket", "blocks")
    open_ = storage.materialise(placed.join(mixed, "bucket").drop("n_shingles"), "open")
    if not open_.isEmpty():
        more = open_links(sets, open_, params)
        found = storage.materialise(components(links.union(more)), "components")
    found = found.select(F.col("node").alias("rep"), "component")
    placed = member.join(found, "rep", "left").select(
        "doc_id", F.coalesce("component", "rep").alias("component_id")
    ).groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = sketched.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
