"""Connected components: few steps, and the same result as before."""

import random

from partload.llm import common
from partload.sources import storage


def test_components_of_many_shapes_and_steps_for_stars(spark, monkeypatch):
    random.seed(3)
    links = [(i, i + 1) for i in range(100, 140)] + [(300, i) for i in range(200, 260)]
    links += [(random.randrange(1000, 1200), random.randrange(1000, 1200)) for _ in range(120)] + [(7, 7), (900, 800)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    df = spark.createDataFrame(links, "a long, b long")
    assert {tuple(r) for r in common.components(df).collect()} == {(x, root(x)) for x in parent}
    # Links to the smallest node of each group are finished as they stand.
    made, write = [], storage.materialise
    monkeypatch.setattr(storage, "materialise", lambda *a: made.append(a) or write(*a))
    star = spark.createDataFrame([(1, i) for i in range(2, 50)] + [(60, 61)], "a long, b long")
    assert common.components(star).count() == 51 and len(made) == 1
