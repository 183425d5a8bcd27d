"""Ranked search against brute force: terms, grids, and whole rankings."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from fixtures import documents, none, words

from partload.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, top=10):
    sets = [(i, terms_of(t)) for i, t in docs]
    sets = [(i, t) for i, t in sets if t]
    n, total = len(sets), sum(len(t) for _, t in sets)
    df = {}
    for _, t in sets:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in items:
        wanted = set(terms_of(text))
        scores = []
        for doc, t in sets:
            m = 100 - 90 + (90 * len(t) * n) // total
            score = 0
            for x in wanted & set(t):
                tf = t.count(x)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x") for i, t in rows], "item_id long, text string, item string, terms string")


ITEMS = [
    (1, "Alpha beta gamma"), (2, None), (3, ""), (4, "!!! ..."), (None, "été 世界 second line"), (5, "no id at all"),
    (1, "Alpha beta gamma"), (6, "nowhere_to be found zzzzzz"), (7, "one One ONE"), (8, "123 x y abc"),
]


@pytest.mark.parametrize("params", [
    ranked.SearchParams(),
    ranked.SearchParams(cells=1, top=3, step=1),
    ranked.SearchParams(cells=300, stretch=0, step=2, step_terms=1, block_terms=5),
    ranked.SearchParams(cells=5000, stretch=3, top=1),
])
def test_ranking_matches_brute_force(spark, params):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = ITEMS + [(9, rows[-1][1]), (10, rows[5][1])]
    got = ranked.ranked(docs, benchmark(spark, items), params).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, items, params.top)


def test_ties_and_many_equal_documents(spark):
    rows = [(500 - i, "same words here") for i in range(400)] + [(i, f"same number {i}") for i in range(600, 650)]
    items = [(1, "same words"), (2, "same"), (3, "number 640 641")]
    docs = documents(spark, [(i, t, "en", "a", None) for i, t in rows]).repartition(7)
    got = ranked.ranked(docs, benchmark(spark, items), ranked.SearchParams(cells=64)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, items)


def test_nothing_to_rank(spark):
    assert ranked.ranked(none(spark), benchmark(spark, ITEMS)).isEmpty()
    assert ranked.ranked(documents(spark), benchmark(spark, [])).isEmpty()
    assert ranked.ranked(documents(spark), benchmark(spark, [(1, "?"), (2, None)])).isEmpty()


def test_long_texts_are_cut_between_terms():
    import random

    rng = random.Random(1)
    texts = [words(rng, 150_000), None, "z" * 3_000_000 + " tail", "", "Ünï " * 10]
    column = pa.array(texts)
    text, term = ranked.term_hashes(*ranked.text_bytes(column))
    assert np.bincount(text, minlength=5).tolist() == [len(terms_of(t)) for t in texts]
    names = [x for t in texts for x in terms_of(t)]
    seen = dict(zip(names, term.tolist(), strict=True))
    assert len(set(seen.values())) == len(seen) and [seen[x] for x in names] == term.tolist()


@pytest.mark.parametrize("seed", range(12))
def test_grid_round_trip_and_best(seed):
    rng = np.random.default_rng(seed)
    rows, cols = int(rng.integers(1, 60)), int(rng.integers(1, 90))
    row, col = np.nonzero(rng.random((rows, cols)) < rng.random())
    if not len(row):
        return
    names, row = np.unique(row, return_inverse=True)
    rows = len(names)
    value = rng.integers(0, [3, 1000, 1_000_000][seed % 3], len(row))
    high, wide = (max(x - 1, 0).bit_length() for x in (rows, cols))
    height = max(high + min(int(rng.integers(0, 6)), wide), wide)
    levels = ranked.build_levels(row, col, value, height, height - high)
    grid = ranked.Grid({
        "height": height, "up": height - high, "largest": int(value.max()), "levels": levels,
        "doc_ids": np.arange(cols).tobytes(), "no_id": np.packbits(np.zeros(cols, bool)).tobytes(),
        "terms": np.arange(rows).astype(np.uint64).tobytes(),
    })
    assert sorted(zip(grid.row, grid.col, grid.value)) == sorted(zip(row, col, value))
    sets = [rng.choice(rows, int(rng.integers(1, min(rows, 9) + 1)), replace=False) for _ in range(3)]
    owner = np.repeat(np.arange(3), [len(t) for t in sets])
    weight = rng.integers(1, 5, len(owner))
    params = ranked.SearchParams(top=5, step=int(rng.integers(1, 5)))
    item, score, place = grid.best(owner, np.concatenate(sets), weight, np.ones(3, np.int64), params)
    dense = np.zeros((rows, cols), np.int64)
    dense[row, col] = value
    want = []
    for i, t in enumerate(sets):
        total = (dense[t] * weight[owner == i][:, None]).sum(axis=0)
        want += [(i, s, c) for s, c in sorted((-int(s), c) for c, s in enumerate(total) if s > 0)[:5]]
    assert sorted(zip(item.tolist(), (-score).tolist(), place.tolist())) == sorted(want)
