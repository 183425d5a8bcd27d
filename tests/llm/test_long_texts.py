"""Messages of very many lines and documents of very many paragraphs."""

from __future__ import annotations

import random
import re
import time

from fixtures import documents

from partload.llm import fingerprints, quotes


def _passages(text: str) -> list[tuple[int, list[str]]]:
    out, open_level = [], None
    for line in text.replace("\r", "").split("\n"):
        mark = re.match(r"[ \t]*((?:>[ \t]*)*)", line) if re.match(r"[ \t]*>", line) else None
        level = mark[1].count(">") if mark else 0
        words = " ".join(line[mark.end() if mark else 0 :].lower().split())
        if not words:
            open_level = None
            continue
        if level != open_level:
            out.append((level, []))
            open_level = level
        out[-1][1].append(words)
    return out


def test_passages_as_by_hand(spark):
    rng = random.Random(5)
    lines = ["", "  ", "a b", "> a", ">> a", "> > a", ">", " >x", "A\tB", ">>", "\r", "> ", "y > z"]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(0, 30))) for _ in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    for row in quotes.parsed(df).collect():
        assert [(p.level, list(p.lines)) for p in row.passages] == _passages(texts[row.i])


def test_message_of_very_many_lines(spark):
    body = "\n".join(f"statement {i}" + ("\n" if i % 5 == 4 else "") for i in range(80_000))
    answer = "\n".join(f"> statement {i}\nanswer {i}" for i in range(0, 40_000))
    blank = "x" + "\n" * 100_000 + "y" + " " * 100_000
    rows = [(1, 0, "u", body), (1, 1, "a", answer), (1, 2, "u", ">" * 50_000 + " deep"), (2, 0, "u", blank)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    start = time.time()
    got = {(r.conv_id, r.turn): r for r in quotes.link_quotations(df).collect()}
    # A pass over the lines for each line takes many minutes.
    assert time.time() - start < 90
    second = got[1, 1]
    assert (second.passages, second.linked, second.reply_to) == (40_000, 40_000, 0)
    assert second.clean == "\n".join(f"answer {i}" for i in range(40_000))
    assert got[1, 2].levels == 50_000
    assert got[2, 0].clean == "x" + "\n" * 100_000 + "y"


def test_difference_of_very_many_paragraphs(spark):
    rng = random.Random(6)
    old = [f"paragraph {rng.getrandbits(60)}" for _ in range(20_000)]
    new = old[:15_000] + [f"other {rng.getrandbits(60)}" for _ in range(5_000)]
    rows = [(1, "\n".join(old), "en", "a", 0), (2, "\n".join(new), "en", "a", 0)]
    start = time.time()
    got = {r.doc_id: r for r in fingerprints.fingerprints(documents(spark, rows)).collect()}
    assert time.time() - start < 120
    assert got[1].near_next == got[2].near_next == 15_000 / 25_000


def test_cells_by_hand(spark):
    rng = random.Random(7)
    params = fingerprints.SketchParams()
    sets = [[rng.getrandbits(63) - (1 << 62) for _ in range(n)] for n in (0, 1, 2, 9, 40, 300)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "i long, keys array<bigint>")
    for s in (1, params.cells, 64):
        got = df.selectExpr("i", f"{fingerprints.sketch('keys', str(s))} AS cells").collect()
        digests = df.selectExpr(
            "i", f"transform(keys, k -> array(k, xxhash64(k, 7), pmod(xxhash64(k, 1), {s}), pmod(xxhash64(k, 2), {s}), "
            f"pmod(xxhash64(k, 3), {s}))) AS d"
        )
        made = {r.i: r.d for r in digests.collect()}
        for row in got:
            want = [[0, 0, 0] for _ in range(3 * s)]
            for k, c, *places in made[row.i]:
                for table, place in enumerate(places):
                    cell = want[table * s + place]
                    cell[0], cell[1], cell[2] = cell[0] + 1, cell[1] ^ k, cell[2] ^ c
            assert [[c.n, c.k, c.c] for c in row.cells] == want
