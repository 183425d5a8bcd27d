"""Repeated lines and whitened embeddings against brute force."""

import math

import numpy as np
import pytest
from fixtures import documents, none
from pyspark.sql import functions as F

from partload.llm import lines, whitening

SPACE = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return line.strip(SPACE).translate(FOLD)


def brute_lines(rows):
    holders = {}
    place = lambda i: (i is None, i or 0)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 10:
                holders.setdefault(key_of(line), set()).add(place(doc))
    out = []
    for doc, text in rows:
        all_ = (text or "").split("\n")
        kept = [x for x in all_ if len(holders.get(key_of(x), ())) < 2 or min(holders[key_of(x)]) == place(doc)]
        out.append((doc, len(all_), len(all_) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


LINES = [
    (1, "A line that repeats\nshort\nA LINE that repeats  \nown line of one"),
    (2, "\ta line That repeats\r\nshort\n\n\n"),
    (2, "a line that repeats\nanother line of two"),
    (3, "another line of two\n\x0bAnother line of two\x0c\nlast\n"),
    (None, "a line that repeats\nonly without an id"),
    (None, "only without an id\nanother line of two"),
    (4, "only within one\nonly within one"),
    (5, None), (6, ""), (7, "\n"), (8, "été été été é"), (9, "ÉTÉ été été é\nÉTÉ été été é"), (10, "ÉTÉ été été é"),
    (11, "\xa0a line that repeats"), (12, "123456789\n 1234567890"), (13, "123456789\n1234567890 "),
    (14, "\n".join(f"line number {i}" for i in range(20_000))),
    (15, "\n".join(f"Line Number {i}" for i in range(19_990, 20_010))),
    (15, "\n".join(f"Line Number {i}" for i in range(19_990, 20_010))),
]


@pytest.mark.parametrize("params", [
    lines.LineParams(),
    lines.LineParams(bits=1, probes=1),
    lines.LineParams(per_shard=500, probes=2),
])
def test_lines_match_brute_force(spark, params):
    docs = documents(spark, [(i, t, "en", "a", None) for i, t in LINES])
    got = [tuple(r) for r in lines.drop_repeated_lines(docs, params).collect()]
    assert sorted(got, key=repr) == brute_lines(LINES)


def test_lines_take_every_hazard(spark):
    docs = documents(spark)
    got = [tuple(r) for r in lines.drop_repeated_lines(docs).collect()]
    want = brute_lines([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(got, key=repr) == want
    assert lines.drop_repeated_lines(none(spark)).isEmpty()


def test_a_line_of_every_document(spark):
    docs = spark.range(30_000).select(
        (F.col("id") + 5).alias("doc_id"),
        F.concat(F.lit("The line of all documents\nline of "), F.col("id").cast("string"), F.lit(" alone")).alias("text"),
    )
    out = lines.drop_repeated_lines(docs).groupBy("n_dropped").agg(F.count("*"), F.min("doc_id"), F.max("doc_id"))
    assert sorted(map(tuple, out.collect())) == [(0, 1, 5, 5), (1, 29_999, 6, 30_004)]


def test_filters_keep_what_is_seen_twice_and_little_else(spark):
    once = spark.range(200_000).select(F.xxhash64("id").alias("h"))
    twice = once.limit(2_000)
    keys = once.union(twice)
    params = lines.LineParams()
    filters, words = lines.twice_seen(keys, params)
    mask = lines._mask(F.col("h"), params.probes)
    hit = once.withColumn("word", lines._word(F.col("h"), words)).join(filters, "word")
    hit = hit.where(F.col("bits").bitwiseAND(mask) == mask)
    assert hit.join(twice, "h", "left_semi").count() == twice.count()
    assert hit.count() < 12_000


SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string, component string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None, "x", "n", "c") for i, v in rows], SCHEMA)


def brute_whitening(rows, k=16):
    """(vec_id, deviation, whitened of all components) of those rows that take part, with numpy's solver."""
    used = [(i, [math.floor(64.0 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in used}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    y = (n * fit - sums).astype(float) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = []
    for i, x in used:
        exact = n * np.array(x, dtype=object) - sums
        out.append((i, int((exact ** 2).sum()), (exact.astype(float) / n) @ u / np.sqrt(e)))
    return n, e / np.trace(y.T @ y / n), out


@pytest.mark.parametrize("dim,count", [(24, 400), (3, 50), (1, 9), (40, 2000)])
def test_whitening_matches_brute_force(spark, dim, count):
    rng = np.random.default_rng(dim)
    base = rng.standard_normal((count, dim)) * rng.uniform(0.2, 3, dim) + rng.uniform(-9, 9, dim)
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(5, rows[0][1]), (None, rows[1][1]), (90_000, None), (90_001, []), (90_002, [None] * dim),
             (90_003, [float("nan")] * dim), (90_004, [float("inf")] * dim), (90_005, [1.0] * (dim + 1))]
    got = whitening.whiten(vectors(spark, rows)).collect()
    n, explained, want = brute_whitening([r for r in rows if r[0] != 90_005])
    k = len(explained)
    assert {r.n for r in got} == {n} and len(got) == k * len(want) and max(r.identity_error for r in got) < 1e-9
    mine = {}
    for r in got:
        mine.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    assert {(i, d) for i, d, _ in want} == set(mine)
    sign = np.ones(k)
    for i, d, w in want:
        row = np.array([mine[i, d][c + 1].whitened for c in range(k)])
        sign = np.where(np.abs(w) > 0.5, np.sign(w * row), sign)
    for i, d, w in want:
        row = np.array([mine[i, d][c + 1].whitened for c in range(k)])
        assert np.allclose(row * sign, w, atol=1e-7)
        assert np.allclose([mine[i, d][c + 1].explained for c in range(k)], explained, rtol=1e-9)


def test_whitening_without_variance(spark):
    assert whitening.whiten(vectors(spark, [])).isEmpty()
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).isEmpty()
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).isEmpty()
    flat = whitening.whiten(vectors(spark, [(i, [float(i), 5.0, 0.0]) for i in range(9)])).collect()
    assert len(flat) == 9 and all(r.component == 1 and r.explained == 1.0 for r in flat)


def test_whitening_of_huge_entries(spark):
    rows = [(i, [float(i) * 1e15, float(i % 3)]) for i in range(1, 30)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert len(got) == 29 and {r.component for r in got} == {1} and all(r.deviation is None for r in got if r.vec_id < 5)
    assert np.isclose(np.mean([r.whitened**2 for r in got]), 1)


@pytest.mark.parametrize("kind", ["random", "equal", "pairs", "blocks", "diagonal"])
def test_eigenpairs(kind):
    rng = np.random.default_rng(4)
    d = 48
    if kind == "random":
        a = rng.standard_normal((d, 2 * d))
        v = a @ a.T
    elif kind == "equal":
        v = 7.0 * np.eye(d)
    elif kind == "diagonal":
        v = np.diag(rng.random(d))
    else:
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        v = q @ np.diag(np.repeat(np.arange(1.0, d // 2 + 1), 2)) @ q.T
        if kind == "blocks":
            v[: d // 2, d // 2 :] = v[d // 2 :, : d // 2] = 0
    v = (v + v.T) / 2
    e, u = whitening.principal(v, 16)
    assert np.allclose(e, np.linalg.eigvalsh(v)[::-1][:16], rtol=1e-12, atol=0)
    assert np.abs(u.T @ u - np.eye(16)).max() < 1e-12
    assert np.abs(v @ u - u * e).max() < 1e-12 * e[0]


def test_huge_whole_numbers_stay_exact():
    x = np.array([[1 << 60, 3], [5, 1 << 59]], dtype=np.int64)
    y, exact = whitening._centred(x, 3, np.array([7, 8], dtype=object))
    assert exact.tolist() == [[3 * (1 << 60) - 7, 1], [8, 3 * (1 << 59) - 8]]
    assert y[0, 1] == 1 / 3
