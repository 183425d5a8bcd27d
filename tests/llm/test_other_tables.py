"""The operators on vectors, pages and conversations, and the pipeline."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from partload.llm import quotes, vectors, warc


# --- vectors --------------------------------------------------------------------------------


def vector_rows():
    rng = np.random.default_rng(4)
    rows = []
    for size in (1, 1, 1, 2, 5, 40):
        centre = rng.normal(size=16)
        rows += [(centre + rng.normal(size=16) * 0.12).tolist() for _ in range(size)]
    rows += [rows[3]] * 4
    rows += [rng.normal(size=16).tolist() for _ in range(60)]
    rows += [None, [], [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e200] * 16, [1e-200] * 16]
    order = list(range(len(rows)))
    random.Random(1).shuffle(order)
    return [(i, rows[j]) for i, j in enumerate(order)]


def test_vectors_match_brute_force(spark):
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, list int, raw string")
    params = vectors.VectorParams(per_list=8, block=16, sample=200)
    got = {r.vec_id: r for r in vectors.near_vectors(df, params).collect()}
    assert len(got) == len(rows)
    good = {}
    for i, v in rows:
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.array(v) / np.abs(v).max()
            good[i] = x / np.linalg.norm(x)
    links = {(a, b) for a in good for b in good if a != b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.95}
    want = Counter(a for a, _ in links)
    assert sum(r.n_links for r in got.values()) >= 0.9 * len(links)
    group = {i: i for i, _ in rows}
    for _ in rows:
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    for i, r in got.items():
        assert r.n_links <= want[i]
        assert r.kept == (r.component_id == i)
    assert sum(r.component_id == group[i] for i, r in got.items()) >= 0.95 * len(rows)
    assert vectors.near_vectors(df.where("false"), params).count() == 0
    ids = df.selectExpr("CAST(NULL AS BIGINT) AS vec_id", "embedding")
    assert {(r.component_id, r.kept) for r in vectors.near_vectors(ids, params).collect()} == {(None, True)}


def test_codes_bound_distances():
    rng = np.random.default_rng(2)
    points = rng.normal(size=(500, 32))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    index = vectors.Index(points, 4, vectors.VectorParams(codes=16))
    codes, error = index.encode(points - index.centres[0])
    far = index.distances(points[:50], index.centres[0], codes)
    true = np.linalg.norm(points[:50, None] - points[None], axis=2)
    assert (np.abs(far - true) <= error[None] + 1e-9).all()


# --- archives -------------------------------------------------------------------------------


def test_archives(spark):
    pages = [(3, "http://a/é b", "same"), (1, None, "same"), (2, "u", None), (5, "u", ""), (4, "x\r\ny", "a\r\n\r\nb" * 9),
             (None, "u", "same"), (1, None, "same"), (6, "u", "ü" * 100_000)]
    df = spark.createDataFrame([(*p, "x", 0) for p in pages], "page_id long, url string, html string, digest string, refers_to int")
    got = warc.round_trip(df, warc.WarcParams(archive_bytes=4000)).collect()
    first = {"same": 1, "": 2}
    want = Counter()
    for page, _, html in pages:
        payload = (html or "").encode()
        top = first.get(html or "")
        revisit = page is not None and top is not None and page > top
        want[page, len(payload), warc.digest_of(payload), "revisit" if revisit else "response", top if revisit else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert warc.round_trip(df.where("false")).count() == 0
    big = warc.round_trip(df, warc.WarcParams(revisit_bytes=3)).collect()
    assert Counter(r.record_type for r in big)["revisit"] == 1


def test_archive_format():
    import io
    import struct

    import zstandard

    params = warc.WarcParams()
    records = [warc.page_record(i, f"http://h/{i}", f"<p>page {i} of many alike</p>" * 20, None, params) for i in range(300)]
    out = io.BytesIO()
    warc.write_archive(records, out, params)
    data = out.getvalue()
    assert struct.unpack("<I", data[:4])[0] == warc.DICTIONARY_FRAME
    read = list(warc.read_archive(data))
    assert [f["WARC-Type"] for _, f, _ in read] == ["warcinfo"] + ["response"] * 300
    size = struct.unpack("<I", data[4:8])[0]
    words = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    at = read[200][0]
    one = zstandard.ZstdDecompressor(dict_data=words).decompressobj().decompress(data[at : read[201][0]])
    assert one == records[199]
    plain = sum(len(zstandard.compress(r)) for r in records)
    assert len(data) < plain
    with pytest.raises(ValueError):
        list(warc.read_archive(b"\0" * 20))


# --- quotations -----------------------------------------------------------------------------


def brute_force_order(messages):
    """(reply_to, place) of one conversation's messages [(turn, quoted turn or None)], depth first."""
    parent = {}
    for i, (turn, quoted) in enumerate(messages):
        parent[turn] = quoted if quoted is not None else (messages[i - 1][0] if i else None)
    children = defaultdict(list)
    for turn, _ in messages:
        children[parent[turn]].append(turn)
    out, stack = [], list(reversed(children[None]))
    while stack:
        turn = stack.pop()
        out.append(turn)
        stack += reversed(children[turn])
    return {turn: (parent[turn], i) for i, turn in enumerate(out)}


def test_quotations_match_brute_force(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for conv in range(4):
        messages, bodies = [], {}
        for turn in range(40 if conv else 1):
            quoted = rng.randrange(turn) if turn and rng.random() < 0.5 else None
            body = f"Message {turn} of {conv}\nwith  a second line"
            text = body
            if quoted is not None:
                lines = bodies[quoted].split("\n")[: rng.choice((1, 2))]
                text = "On Monday they wrote:\n" + "\n".join("> " + x.upper() for x in lines) + f"\n\n{body}"
                if rng.random() < 0.3:
                    text = f">> unknown {turn}\n" + text
            bodies[turn] = body
            messages.append((turn, quoted))
            rows.append((conv, turn, "user", text, "x"))
        for turn, (to, place) in brute_force_order(messages).items():
            want[conv, turn] = (to, place, bodies[turn])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string")
    got = {(r.conv_id, r.turn): r for r in quotes.link_quotations(df).collect()}
    assert len(got) == len(want)
    for key, (to, place, body) in want.items():
        assert (got[key].reply_to, got[key].reply_index) == (to, place)
        assert got[key].clean == body


def test_quotation_levels_and_nulls(spark):
    rows = [
        (1, 0, "u", "Hello  World\nsecond line\n\nanother para"),
        (1, 1, "a", "> hello world\n> second line\nmy answer"),
        (1, 2, "u", ">> Hello world\n> > second line\n> my answer\nI agree"),
        (1, 3, "u", "> nowhere to be found"),
        (2, None, None, None), (2, 0, "x", ""), (None, 1, "y", ">a"), (None, 1, "y", ">a"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = quotes.link_quotations(df).withColumn("chat", quotes.chat_text()).collect()
    by = {(r.conv_id, r.turn, r.role): r for r in got}
    assert len(got) == len(rows)
    second = by[1, 2, "u"]
    assert (second.levels, second.passages, second.linked, second.reply_to, second.clean) == (2, 2, 2, 1, "I agree")
    third = by[1, 3, "u"]
    assert (third.linked, third.reply_to, third.clean, third.reply_index) == (0, 2, "", 3)
    assert by[2, None, None].chat == "<|unknown|>\n\n"
    assert sorted(r.reply_index for r in got if r.conv_id is None) == [0, 1]
    assert quotes.link_quotations(df.where("false")).count() == 0
