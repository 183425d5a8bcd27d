"""Near-duplicate vectors by product quantisation in coarse inverted lists.

Unit vectors are assigned to the nearest coarse centroid, and what is left of them is coded by a small
codebook for each subspace. A query visits every list whose centroid is nearly as near as its own
(`margin`), adds up distances to codes from a table for each subspace, drops whatever the triangle
inequality excludes given the known coding error, and reranks the rest by exact cosine. So only a
list that is not visited can cost a link; the codes lose none.

Queries of a list meet its vectors block by block within tasks. A task returns numbers of links and
a spanning forest of them, never the links, so a group of m near copies costs m rows for a block.
A link between two lists is found once from each end that visits the other's list. A vector carries the
lists that it visits, so a link that only one end finds is told, and counted for the other end too.
Vectors that are equal component by component are one entry of the index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partload.llm.common import components, spread
from partload.sources import storage


@dataclass(frozen=True)
class VectorParams:
    """`per_list`: vectors of an average list; at most `max_lists` lists, so that the centroids sent to
    the tasks are bounded. `sample` vectors train centroids and codebooks. `margin`: how much less
    similar to the query than its own a visited list's centroid may be."""

    cosine: float = 0.95
    per_list: int = 100
    max_lists: int = 16_384
    sample: int = 20_000
    margin: float = 0.14
    subspaces: int = 16
    codes: int = 64
    rounds: int = 6
    block: int = 1024
    seed: int = 5


def _units(raw: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors of packed doubles, padded with zeros to `dim` components."""
    rows = raw.to_pylist()
    sizes = {len(x) for x in rows}
    if sizes == {8 * dim}:
        out = np.frombuffer(b"".join(rows), dtype=np.float64).reshape(-1, dim).copy()
    else:
        out = np.zeros((len(rows), dim))
        for i, x in enumerate(rows):
            out[i, : len(x) // 8] = np.frombuffer(x, dtype=np.float64)
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vectors as packed doubles; null where a vector links with nothing."""
    for batch in batches:
        out = []
        for x in batch.column("embedding"):
            value = None
            if x.is_valid and len(x.values) and not x.values.null_count:
                numbers = np.asarray(x.values.to_numpy(zero_copy_only=False), dtype=np.float64) + 0.0
                if np.isfinite(numbers).all() and numbers.any():
                    value = numbers.tobytes()
            out.append(value)
        yield pa.record_batch({"vec_id": batch.column("vec_id"), "raw": pa.array(out, pa.binary())})


def k_means(points: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Centroids by Lloyd's rounds from random points; an empty cluster keeps its centroid."""
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.empty(len(points), dtype=np.int64)
        half = (centres**2).sum(axis=1) / 2
        for low in range(0, len(points), 2048):
            nearest[low : low + 2048] = np.argmax(points[low : low + 2048] @ centres.T - half, axis=1)
        n = np.bincount(nearest, minlength=len(centres))
        order = np.argsort(nearest, kind="stable")
        filled = n > 0
        sums = np.add.reduceat(points[order], (np.cumsum(n) - n)[filled], axis=0)
        centres[filled] = sums / n[filled][:, None]
    return centres


class Index:
    """Coarse centroids and subspace codebooks, learned from a sample of unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int, params: VectorParams):
        rng = np.random.default_rng(params.seed)
        centres = k_means(sample, lists, params.rounds, rng)
        norm = np.linalg.norm(centres, axis=1, keepdims=True)
        self.centres = np.where(norm > 1e-12, centres / np.maximum(norm, 1e-12), sample[:1])
        own = np.concatenate(
            [np.argmax(sample[i : i + 2048] @ self.centres.T, axis=1) for i in range(0, len(sample), 2048)]
        )
        left = sample - self.centres[own]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(params.subspaces, sample.shape[1]))
        self.books = [k_means(left[:, c], params.codes, params.rounds, rng) for c in self.cuts]

    def encode(self, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals, and the distance of each residual to what its code stands for."""
        codes = np.empty((len(left), len(self.cuts)), dtype=np.uint8)
        error = np.zeros(len(left))
        for m, (cut, book) in enumerate(zip(self.cuts, self.books, strict=True)):
            part = left[:, cut]
            far = (part**2).sum(axis=1)[:, None] - 2 * part @ book.T + (book**2).sum(axis=1)
            codes[:, m] = np.argmin(far, axis=1)
            error += np.square(part - book[codes[:, m]]).sum(axis=1)
        return codes, np.sqrt(error)

    def distances(self, queries: np.ndarray, centre: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Distances of queries to coded vectors of one list, added up from tables."""
        left = queries - centre
        out = np.zeros((len(queries), len(codes)))
        for m, (cut, book) in enumerate(zip(self.cuts, self.books, strict=True)):
            part = left[:, cut]
            table = (part**2).sum(axis=1)[:, None] - 2 * part @ book.T + (book**2).sum(axis=1)
            out += table[:, codes[:, m]]
        return np.sqrt(np.maximum(out, 0))


def _dealt(shared, params: VectorParams):
    """One row for each vector in its list, and one for each list it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                units = _units(part.column("raw"), index.centres.shape[1])
                near = units @ index.centres.T
                own = np.argmax(near, axis=1)
                row, visited = np.nonzero(near >= near.max(axis=1, keepdims=True) - params.margin)
                codes, error = index.encode(units - index.centres[own])
                all_rows = np.concatenate([np.arange(len(units)), row])
                visits = np.split(visited.astype(np.int32), np.searchsorted(row, np.arange(1, len(units))))
                yield pa.record_batch(
                    {
                        "list": pa.array(np.concatenate([own, visited])),
                        "query": pa.array(np.arange(len(all_rows)) >= len(units)),
                        "home": pa.array(own[all_rows]),
                        "visits": pa.array([x.tobytes() for x in visits] + [None] * len(row), pa.binary()),
                        "rep": part.column("rep").take(pa.array(all_rows)),
                        "copies": part.column("copies").take(pa.array(all_rows)),
                        "raw": part.column("raw").take(pa.array(all_rows)),
                        "code": pa.array([x.tobytes() for x in codes] + [None] * len(row), pa.binary()),
                        "error": pa.array(np.concatenate([error, np.zeros(len(row))])),
                    }
                )

    return run


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the smallest node it is connected with by the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _returned(visits: list[bytes], homes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors visit which of the lists `homes`: the place of each in the columns, and the table."""
    lists, column = np.unique(homes, return_inverse=True)
    table = np.zeros((len(visits), len(lists)), dtype=bool)
    visited = np.frombuffer(b"".join(visits), dtype=np.int32)
    row = np.repeat(np.arange(len(visits)), [len(x) // 4 for x in visits])
    place = np.minimum(np.searchsorted(lists, visited), len(lists) - 1)
    hit = lists[place] == visited
    table[row[hit], place[hit]] = True
    return column, table


def _linked(shared, params: VectorParams):
    reach = np.sqrt(max(0.0, 2 - 2 * params.cosine)) + 1e-9

    def run(key: tuple, table: pa.Table) -> pa.Table:
        index = shared.value
        dim = index.centres.shape[1]
        centre = index.centres[key[0].as_py()]
        query = table.column("query").to_numpy()
        base, asks = table.filter(pa.array(~query)), table.filter(pa.array(query))
        out: dict[str, list] = {"a": [], "b": [], "links": []}
        if base.num_rows and asks.num_rows:
            codes = np.frombuffer(b"".join(base.column("code").to_pylist()), np.uint8)
            codes = codes.reshape(base.num_rows, -1)
            vectors, wanted = _units(base.column("raw"), dim), _units(asks.column("raw"), dim)
            width = [np.array([len(x) for x in t.column("raw").to_pylist()]) for t in (base, asks)]
            error, copies = base.column("error").to_numpy(), base.column("copies").to_numpy()
            ids, own = base.column("rep").to_numpy(), asks.column("rep").to_numpy()
            asking = asks.column("copies").to_numpy()
            column, returns = _returned(base.column("visits").to_pylist(), asks.column("home").to_numpy())
            for low in range(0, len(wanted), 512):
                part = slice(low, low + 512)
                close = index.distances(wanted[part], centre, codes) - error <= reach
                close &= own[part][:, None] != ids[None, :]
                i, j = np.nonzero(close)
                i += low
                exact = np.empty(len(i))
                for at in range(0, len(i), 65_536):
                    s = slice(at, at + 65_536)
                    exact[s] = np.einsum("ij,ij->i", wanted[i[s]], vectors[j[s]])
                good = (exact >= params.cosine) & (width[1][i] == width[0][j])
                i, j = i[good], j[good]
                if not len(i):
                    continue
                asked, place = np.unique(i, return_inverse=True)
                links = np.bincount(place, copies[j]).astype(np.int64)
                names = np.concatenate([own[asked], ids])
                label = forest(place, j + len(asked), len(names))
                used = np.unique(np.concatenate([place, j + len(asked)]))
                out["a"].append(names[used])
                out["b"].append(names[label[used]])
                counts = np.zeros(len(names), dtype=np.int64)
                counts[: len(asked)] = links
                alone = ~returns[j, column[i]]
                counts[len(asked) :] = np.bincount(j[alone], asking[i[alone]], len(ids)).astype(np.int64)
                out["links"].append(counts[used])
        kinds = {"a": np.int64, "b": np.int64, "links": np.int64}
        return pa.table({k: np.concatenate(v) if v else np.zeros(0, kinds[k]) for k, v in out.items()})

    return run


def near_vectors(vectors: DataFrame, params: VectorParams = VectorParams()) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of vectors (vec_id, embedding).

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing;
    vectors of different length do not link with each other. Each row is a vector of its own, also
    when it repeats an id. A component of null ids alone is null; its vectors are kept.
    Other columns are not looked at.
    """
    spark = vectors.sparkSession
    packed = storage.materialise(
        vectors.select("vec_id", "embedding").mapInArrow(_packed, "vec_id long, raw binary"), "packed"
    )
    classes = packed.where("raw IS NOT NULL").groupBy("raw").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    # A class that has only null ids takes part under a name of its own above all others.
    name = F.coalesce("rep", F.lit(1 << 62) + F.pmod(F.xxhash64("raw"), F.lit(1 << 61)))
    classes = storage.materialise(classes.select("raw", name.alias("rep"), "copies"), "classes")
    size = classes.agg(F.count(F.lit(1)), F.max(F.length("raw"))).first()
    if not size[0]:
        return packed.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    parts = 1_000_000
    share = F.pmod(F.xxhash64("raw"), F.lit(parts)) < F.lit(max(1, parts * params.sample // size[0]))
    sample = classes.where(share).select("raw").toArrow().column("raw").combine_chunks()
    if not len(sample):
        sample = pa.array([r["raw"] for r in classes.select("raw").take(1)], pa.binary())
    lists = min(params.max_lists, spread(size[0], params.per_list))
    index = Index(_units(sample, size[1] // 8), lists, params)
    shared = spark.sparkContext.broadcast(index)
    entries = storage.materialise(
        classes.mapInArrow(
            _dealt(shared, params),
            "list long, query boolean, home long, visits binary, rep long, copies long, raw binary, code binary, "
            "error double",
        ),
        "entries",
    )
    counts = entries.groupBy("list").agg(
        F.ceil(F.count(F.when(~F.col("query"), 1)) / params.block).alias("bases"),
        F.ceil(F.count(F.when(F.col("query"), 1)) / (4 * params.block)).alias("asks"),
    )
    # Each vector of a block meets every block of queries, and the other way round.
    mine = F.pmod(F.xxhash64("rep"), F.when(F.col("query"), F.col("asks")).otherwise(F.col("bases")))
    other = F.explode(
        F.sequence(F.lit(0).cast("long"), F.when(F.col("query"), F.col("bases")).otherwise(F.col("asks")) - 1)
    )
    dealt = (
        entries.join(counts.where("bases > 0 AND asks > 0"), "list")
        .withColumn("mine", mine).withColumn("other", other)
        .withColumn("base", F.when(F.col("query"), F.col("other")).otherwise(F.col("mine")))
        .withColumn("ask", F.when(F.col("query"), F.col("mine")).otherwise(F.col("other")))
        .drop("bases", "asks", "mine", "other")
    )
    found = storage.materialise(
        dealt.groupBy("list", "base", "ask").applyInArrow(_linked(shared, params), "a long, b long, links long"),
        "links",
    )
    joined = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    decided = (
        classes.join(links, "rep", "left")
        .join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select(
            "raw",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    out = packed.join(decided, "raw", "left")
    component = F.coalesce(F.when(F.col("component") < 1 << 62, F.col("component")), "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
