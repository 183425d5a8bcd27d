"""Whitening of embeddings: principal components of a centred covariance, found step by step.

1. Entries become whole numbers; each distinct vector is fitted once. Counts and sums are exact.
2. Tasks multiply centred vectors into partial covariances, which meet row by row of the matrix.
3. The matrix (dimension x dimension, whatever the number of rows) is brought to tridiagonal form by
   Householder reflections. Sturm counts bisect its leading eigenvalues, and inverse iteration
   finds their vectors, those of close eigenvalues being kept orthogonal to each other.
4. Mean and components are broadcast, and every row is projected where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partload.sources import storage

_EPS = np.finfo(np.float64).eps


@dataclass(frozen=True)
class WhiteningParams:
    """`components`: how many at most. An entry c becomes floor(scale * c) + shift."""

    components: int = 16
    scale: int = 64
    shift: int = 1_000_000


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and Q of a symmetric matrix a = Q T Q', by Householder reflections."""
    a = a.copy()
    d = len(a)
    q = np.eye(d)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        if not np.any(x[1:]):
            continue
        image = -np.copysign(np.linalg.norm(x), x[0])
        x[0] -= image
        x /= np.linalg.norm(x)
        # Two-sided update of the trailing block by one rank-two correction.
        p = a[k + 1 :, k + 1 :] @ x
        w = p - (x @ p) * x
        a[k + 1 :, k + 1 :] -= 2 * (np.outer(x, w) + np.outer(w, x))
        a[k + 1, k] = a[k, k + 1] = image
        a[k + 2 :, k] = a[k, k + 2 :] = 0
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix are below each of the points `at`."""
    tiny = _EPS * max(np.abs(off).max(initial=0), np.finfo(np.float64).tiny)
    pivot = diagonal[0] - at
    count = (pivot < 0).astype(np.int64)
    for i in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < tiny, np.where(pivot < 0, -tiny, tiny), pivot)
        pivot = diagonal[i] - at - off[i - 1] ** 2 / pivot
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected to the last bits."""
    d = len(diagonal)
    edge = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low = np.full(k, (diagonal - edge).min())
    high = np.full(k, (diagonal + edge).max())
    width = max(abs(low[0]), abs(high[0]), np.finfo(np.float64).tiny)
    low, high = low - _EPS * width, high + 2 * _EPS * width
    below = d - 1 - np.arange(k)
    for _ in range(128):
        middle = low + (high - low) / 2
        if np.all((middle == low) | (middle == high)):
            break
        # The i-th largest lies above a point with at most d - 1 - i values below it.
        above = sturm_counts(diagonal, off, middle) <= below
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return low + (high - low) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, value: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """x of (T - value) x = b by elimination with row exchanges; pivots of zero become tiny."""
    d = len(diagonal)
    main, up, up2 = diagonal - value, np.append(off, 0.0), np.zeros(d)
    low, x = off, b.copy()
    for i in range(d - 1):
        if abs(low[i]) > abs(main[i]):
            factor = main[i] / low[i]
            row = (low[i], main[i + 1], up[i + 1])
            main[i + 1], up[i + 1] = up[i] - factor * row[1], -factor * row[2]
            main[i], up[i], up2[i] = row
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            if abs(main[i]) < tiny:
                main[i] = tiny
            factor = low[i] / main[i]
            main[i + 1] -= factor * up[i]
            x[i + 1] -= factor * x[i]
    for i in range(d - 1, -1, -1):
        if abs(main[i]) < tiny:
            main[i] = tiny
        rest = (up[i] * x[i + 1] if i + 1 < d else 0.0) + (up2[i] * x[i + 2] if i + 2 < d else 0.0)
        x[i] = (x[i] - rest) / main[i]
    return x


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of falling eigenvalues by inverse iteration, one in each column.

    Values closer than a thousandth of the norm form a cluster; each vector is made orthogonal to the
    earlier ones of its cluster after every step, and equal values are moved apart by a few bits.
    """
    d, norm = len(diagonal), max(np.abs(diagonal).max(), np.abs(off).max(initial=0))
    tiny = max(_EPS * norm, np.finfo(np.float64).tiny)
    rng = np.random.default_rng(0)
    out = np.zeros((d, len(values)))
    first, used = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        # A few bits apart from the last one used, or both would give the same vector.
        used = min(value, used - 4 * tiny) if j > first else value
        x = rng.standard_normal(d)
        for _ in range(5):
            x = _solve(diagonal, off, used, x / np.linalg.norm(x), tiny)
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
            x /= np.linalg.norm(x)
        out[:, j] = x
    return out


def principal(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and unit eigenvectors of a symmetric matrix.

    Only directions of measurable variance, which is above 1e-12 of the largest.
    """
    d = len(v)
    size = np.abs(v).max(initial=0)
    if not d or not size:
        return np.zeros(0), np.zeros((d, 0))
    diagonal, off, q = tridiagonal(v / size)
    values = leading_values(diagonal, off, min(k, d))
    values = values[values > 1e-12 * values[0]]
    vectors = q @ leading_vectors(diagonal, off, values)
    return values * size, vectors / np.linalg.norm(vectors, axis=0)


def _matrix(column: pa.Array) -> np.ndarray:
    """List rows of one length as a matrix of long."""
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)
    return values.reshape(len(column), -1)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """x - sums / n as double, rounded once, and the exact n * x - sums it comes from."""
    # Python's whole numbers where 64 bits could run over.
    wide = np.abs(x).max(initial=0) > (1 << 61) // n
    exact = n * x.astype(object) - sums.astype(object) if wide else n * x - sums.astype(np.int64)
    return exact.astype(np.float64) / n, exact


def _products(n: int, sums: np.ndarray, project: np.ndarray | None):
    """Partial sums of products of centred (and projected) vectors: one row for each matrix row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            y, _ = _centred(_matrix(batch.column("x")), n, sums)
            y = y if project is None else y @ project
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.record_batch(
                {"i": pa.array(range(len(total)), pa.int32()), "part": pa.array(list(total), pa.list_(pa.float64()))}
            )

    return run


def _added(key: tuple, table: pa.Table) -> pa.Table:
    rows = np.array(table.column("part").to_pylist(), dtype=np.float64)
    return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "part": [rows.sum(axis=0)]})


def covariance(fit: DataFrame, n: int, sums: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    """The centred covariance, divisor n, of the fit list or of its projection.

    Each task sends one row of numbers for each row of the matrix; those meet by row.
    """
    parts = fit.select("x").mapInArrow(_products(n, sums, project), "i int, part array<double>")
    rows = parts.groupBy("i").applyInArrow(_added, "i int, part array<double>").collect()
    out = np.array([r.part for r in sorted(rows, key=lambda r: r.i)]) / n
    return (out + out.T) / 2


def whole_vectors(rows: DataFrame, params: WhiteningParams) -> DataFrame:
    """(vec_id, x) of the rows that take part: vectors of finite numbers in whole steps."""
    vector = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall(
        "embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    step = lambda c: F.floor(F.lit(float(params.scale)) * c) + F.lit(params.shift).cast("long")
    taken = rows.where(fine & (F.size("embedding") > 0))
    return taken.select("vec_id", F.transform(vector, step).alias("x"))


def _projected(shared, params: WhiteningParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, project, explained, error = shared.value
        k = project.shape[1]
        for batch in batches:
            for low in range(0, batch.num_rows, 4096):
                part = batch.slice(low, 4096)
                y, exact = _centred(_matrix(part.column("x")), n, sums)
                size = (exact.astype(np.float64) ** 2).sum(axis=1)
                far = size.max(initial=0) > 2.0**62
                deviation = ((exact.astype(object) if far else exact) ** 2).sum(axis=1)
                if far:
                    deviation = [v if v < 1 << 63 else None for v in deviation.tolist()]
                yield pa.record_batch(
                    {
                        "vec_id": part.column("vec_id").take(np.repeat(np.arange(part.num_rows), k)),
                        "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                        "n": pa.array(np.full(part.num_rows * k, n)),
                        "deviation": pa.array(deviation, pa.int64()).take(np.repeat(np.arange(part.num_rows), k)),
                        "whitened": pa.array((y @ project).reshape(-1)),
                        "explained": pa.array(np.tile(explained, part.num_rows)),
                        "identity_error": pa.array(np.full(part.num_rows * k, error)),
                    }
                )

    return run


_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def whiten(rows: DataFrame, params: WhiteningParams = WhiteningParams()) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of rows (vec_id, embedding).

    A row whose vector is null, empty, or holds a null or an entry that is not finite is left out. So is
    one whose vector is shorter or longer than most (of two equally common lengths the shorter counts).
    Vectors that become equal in whole steps are fitted once; every row, also a repeated one or one
    without an id, is projected. Components without variance do not exist, so a single distinct
    vector gives no rows. `deviation` is null where its exact value exceeds 64 bits. Other columns
    are not looked at.
    """
    spark = rows.sparkSession
    every = storage.materialise(whole_vectors(rows.select("vec_id", "embedding"), params), "vectors")
    lengths = every.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), "d").first()
    if common is None:
        return every.where("false").selectExpr(*[f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in _OUT.split(", ")])
    every = every.where(F.size("x") == common.d)
    fit = storage.materialise(every.select("x").distinct(), "fit")
    total = fit.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("x")[i].cast("decimal(38,0)")) for i in range(common.d)]
    ).first()
    n, sums = total.n, np.array([int(s) for s in total[1:]], dtype=object)
    v = covariance(fit, n, sums)
    values, vectors = principal(v, params.components)
    project = vectors / np.sqrt(values)
    error = 0.0
    if len(values):
        error = float(np.abs(covariance(fit, n, sums, project) - np.eye(len(values))).max())
    shared = spark.sparkContext.broadcast((n, sums, project, values / max(np.trace(v), 5e-324), error))
    return every.mapInArrow(_projected(shared, params), _OUT)
