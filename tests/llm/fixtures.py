"""Small tables with every hazard the operators must take."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

# Names that operators use inside.
CLASHES = ("fp", "_id", "_fp", "_n", "id", "key", "keys", "place", "bucket", "rep", "anchor", "run", "model", "trusted", "size",
           "start", "rank", "n", "digest", "bands", "spans", "first", "place", "digest", "copies", "refers_to")


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdeiorst") for _ in range(rng.randint(2, 7))) for _ in range(n))


def hazards() -> list[tuple]:
    rng = random.Random(3)
    passage = words(rng, 60)
    long = words(rng, 30_000)
    rows = [
        (1, "Alpha beta gamma delta.\nSecond line here\n\nThird", "en", "a", 1),
        (1, "Alpha beta gamma delta.\nSecond line here\n\nThird", "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "en", "b", 0),
        (4, " \t\n\r\x0b\x0c ", None, "b", 7),
        (5, long, "de", "a", len(long)),
        (6, long + " tail", "de", "c", None),
        (None, "no id at all", "fr", None, 12),
        (None, None, "fr", "a", None),
        (None, "no id at all", "fr", None, 12),
        (7, "!!! 123 ???", "en", "a", 11),
        (8, "été ß \U0001f600 世界 x y", "fr", "c", 9),
        (9, "one", "en", "c", 3),
        (10, "One", "en", "d", 3),
    ]
    for i in range(11, 20):
        rows.append((i, f"{words(rng, 20)} {passage} {words(rng, 30)}", "en", "a", None))
    for i in range(20, 26):
        body = passage.split()
        body[i - 20] = "changed"
        rows.append((i, " ".join(body), "es", "b", None))
    return rows


def documents(spark, rows=None):
    """Documents with extra columns whose names the operators use."""
    df = spark.createDataFrame(hazards() if rows is None else rows, DOCUMENTS)
    for name in dict.fromkeys(CLASHES):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


def none(spark):
    return documents(spark, []).where("false")


def labels(spark):
    rows = [(i, 1, 0) for i in (1, 5, 11, 12, 13, 14, 15)] + [(16, 0, 0), (17, 1, 1), (None, 1, 0), (99, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
