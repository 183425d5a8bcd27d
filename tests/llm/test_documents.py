"""The document operators against brute force, and on tables with every hazard."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from fixtures import documents, hazards, labels, none

from partload.llm import fingerprints, langid, minhash, mixing, packing, quality, substring
from partload.llm.queries import tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


def ids(rows):
    return Counter(r.doc_id for r in rows)


EXPECTED = Counter(r[0] for r in hazards())


# --- near duplicates ------------------------------------------------------------------------


def shingles(text, k):
    w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, k, percent):
    params = minhash.NearParams(shingle=k, percent=percent, block=200)
    got = minhash.near_duplicates(documents(spark), params).collect()
    assert ids(got) == EXPECTED
    sets = {(r[0], i): shingles(r[1], k) for i, r in enumerate(hazards())}
    group = {d: d for d, _ in sets if d is not None}

    def top(d):
        while group[d] != d:
            d = group[d]
        return d

    named = [(d, s) for (d, _), s in sets.items() if d is not None and s]
    for a, x in named:
        for b, y in named:
            if a < b and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((top(a), top(b)))
                group[high] = low
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == top(r.doc_id) and r.kept == (r.component_id == r.doc_id)
    assert {r.n_shingles for r in got if r.doc_id == 5} == {len(shingles(hazards()[5][1], k))}
    assert minhash.near_duplicates(none(spark), params).count() == 0


def test_sketches_fill_every_coordinate():
    import numpy as np

    sets = [np.arange(n, dtype=np.uint64) * np.uint64(7919) for n in (1, 2, 5, 500)]
    sketch = minhash.sketches(sets, 120)
    assert (sketch != np.iinfo(np.uint64).max).all()
    big = np.arange(2000, dtype=np.uint64)
    agree = [
        (np.equal(*minhash.sketches([big[:1000] + np.uint64(1000 * i), big[100:1100] + np.uint64(1000 * i)], 120))).mean()
        for i in range(1, 20)
    ]
    assert abs(np.mean(agree) - 900 / 1100) < 0.03


def test_blocks_of_a_bucket_find_every_link(spark):
    """Documents that link in chains but not with their bucket's pivot."""
    rows = []
    base = [f"w{i}" for i in range(100)]
    for i in range(30):
        rows.append((i, " ".join(base[3 * i % 60 :] + [f"x{i}"] * 2 + base[: 3 * i % 60]), "en", "a", 0))
    params = minhash.NearParams(shingle=1, percent=85, block=50)
    got = minhash.near_duplicates(documents(spark, rows), params).collect()
    assert {r.component_id for r in got} == {0}


# --- repeated passages ----------------------------------------------------------------------


@pytest.mark.parametrize("window", [5, 35])
def test_repeats_match_brute_force(spark, window):
    got = substring.remove_repeats(documents(spark), substring.RepeatParams(window=window)).collect()
    assert ids(got) == EXPECTED
    texts = [words_of(r[1]) for r in hazards()]
    starts = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    want = Counter()
    for row, w in zip(hazards(), texts, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        want[row[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == want
    for r in got:
        assert sum(s.end - s.start for s in r.repeats) == r.n_removed
    assert substring.remove_repeats(none(spark)).count() == 0


def test_repeats_within_one_document(spark):
    text = " ".join(["a b c d e f g h i j"] * 3)
    out = substring.remove_repeats(documents(spark, [(1, text, "en", "a", 0)]), substring.RepeatParams(window=6)).first()
    assert (out.n_words, out.n_removed, out.kept_text) == (30, 30, "")


# --- packing --------------------------------------------------------------------------------


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    got = packing.pack(documents(spark), path).collect()
    want = Counter()
    for r in hazards():
        tokens = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        cut = len(tokens) % 2048 or 2048
        bounds = [0, *range(cut, len(tokens) + 1, 2048)]
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            raw = b"".join(t.to_bytes(4, "little") for t in tokens[a:b])
            want[r[0], i, a, b - a, zlib.crc32(raw)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= math.ceil(sum(r.length for r in got) / 2048) + 1
    assert packing.pack(none(spark), path).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_constraint(rule):
    import numpy as np

    lengths = np.random.default_rng(1).integers(1, 400, 500)
    params = packing.PackParams(tokens=400, documents=5, attention=60_000, weights=(1, 0.3, 0.5), rule=rule)
    lengths = lengths[lengths**2 <= params.attention]
    bins = packing.best_fit(lengths, params)
    assert np.bincount(bins, lengths).max() <= 400 and np.bincount(bins).max() <= 5
    assert np.bincount(bins, lengths**2).max() <= 60_000
    with pytest.raises(ValueError):
        packing.best_fit(np.array([401]), params)


# --- mixing ---------------------------------------------------------------------------------


def water_filled(sizes):
    """Targets of sources in order, by resharing the excess until none is above."""
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sizes)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        free = [s for s in sizes if s not in full]
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 2 * sizes[s]}
        if not above:
            return {**{s: 2 * sizes[s] for s in full}, **share}
        full |= above


def test_mixing(spark):
    params = mixing.MixParams(block_words=16, shard_slots=64)
    got = mixing.words_taken(mixing.mix(documents(spark), params)).collect()
    again = mixing.words_taken(mixing.mix(documents(spark).repartition(5), params)).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert ids(got) == EXPECTED
    sizes = Counter()
    for r in hazards():
        sizes[r[3]] += len(words_of(r[1]))
    order = sorted((s for s in sizes if s is not None)) + [None]
    targets = water_filled({s: sizes[s] for s in order})
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 32
    assert mixing.words_taken(mixing.mix(none(spark))).count() == 0


def test_mixed_documents_hold_the_taken_words(spark):
    params = mixing.MixParams(block_words=16, shard_slots=64)
    docs = documents(spark)
    out = mixing.mixed_documents(docs, params)
    assert out.columns == docs.columns
    got, want = Counter(), Counter()
    for r in out.collect():
        got[r.doc_id, r.source] += len(words_of(r.text))
        assert r.n_chars == len(r.text)
    for r in mixing.words_taken(mixing.mix(docs, params)).collect():
        if r.taken:
            want[r.doc_id, r.source] += r.taken
    assert got == want


def test_permutations():
    import numpy as np

    for n in (1, 2, 3, 17, 1000):
        out = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 99))
        assert sorted(out.tolist()) == list(range(n))


# --- fingerprints ---------------------------------------------------------------------------


def paragraphs(text):
    return {line[i : i + fingerprints.PIECE] for line in text.split("\n") for i in range(0, len(line), fingerprints.PIECE)}


def test_fingerprints(spark):
    rows = [r for r in hazards() if r[0] is not None and r[0] not in (5, 6)]
    rows = [r for i, r in enumerate(rows) if i != 1]  # ids once
    rows.append((30, "\n".join(f"line {i}" for i in range(150)), "en", "a", 0))
    rows.append((31, "\n".join(f"line {i}" for i in range(20, 170)), "en", "a", 0))
    got = {r.doc_id: r for r in fingerprints.fingerprints(documents(spark, rows)).collect()}
    texts = {r[0]: r[1] or "" for r in rows}
    order = sorted(texts)
    seen = {}
    for i, d in enumerate(order):
        text, after = texts[d], texts[order[(i + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[d]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other, value in ((edited, r.near_edited), (after, r.near_next)):
            a, b = paragraphs(text), paragraphs(other)
            assert value == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert seen.setdefault(text, r.fingerprint) == r.fingerprint
    everything = fingerprints.fingerprints(documents(spark)).collect()
    assert ids(everything) == EXPECTED
    assert fingerprints.fingerprints(none(spark)).count() == 0


# --- languages ------------------------------------------------------------------------------


def test_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    out = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in out) >= 0.95 * len(out)
    edge = langid.identify(documents(spark)).collect()
    assert ids(edge) == EXPECTED
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in edge if r.doc_id in (2, 3, 4, 7))
    assert langid.identify(none(spark)).count() == 0


def test_out_of_place_distance():
    import numpy as np
    import pyarrow as pa

    grams = [ord("a"), ord("b"), ord("c")]
    rows = pa.table({"lang": ["x", "x", "y", "y"], "gram": [grams[0], grams[1], grams[1], grams[2]],
                     "place": [0, 1, 0, 1]})
    profiles = langid.Profiles(rows, 10)
    letters = np.array([32, *map(ord, "aab")])
    own = [g for g, _ in sorted(Counter(langid._grams(letters).tolist()).items(), key=lambda x: (-x[1], x[0]))]
    far = {lang: sum(abs(own.index(g) - p[g]) if g in p else 10 for g in own)
           for lang, p in (("x", {grams[0]: 0, grams[1]: 1}), ("y", {grams[1]: 0, grams[2]: 1}))}
    assert profiles.nearest(letters) == ("x", 1 - far["x"] / (10 * len(own)))


# --- quality --------------------------------------------------------------------------------


def brute_force_model(texts):
    """Interpolated modified Kneser-Ney over characters, by dictionaries."""
    counts = [None] * 5
    counts[4] = Counter(t[i : i + 4] for t in texts for i in range(len(t) - 3))
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    rates, totals = {}, {}
    for k in (1, 2, 3, 4):
        n = Counter(counts[k].values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
        d = [0.0]
        for i in (1, 2, 3):
            value = i - (i + 1) * y * n[i + 1] / n[i] if n[i] else -1
            d.append(value if n[1] and 0 < value < i else i / 2)
        rates[k] = d
        sums = defaultdict(lambda: [0, 0.0])
        for g, c in counts[k].items():
            sums[g[:-1]][0] += c
            sums[g[:-1]][1] += d[min(c, 3)]
        totals[k] = sums

    def p(g):
        if not g:
            return 1 / (len(counts[1]) + 1)
        k, c = len(g), counts[len(g)][g]
        total, rest = totals[k].get(g[:-1], (0, 0.0))
        if not total:
            return p(g[1:])
        return (c - rates[k][min(c, 3)] if c else 0) / total + rest / total * p(g[1:])

    return p


def test_perplexity_matches_brute_force(spark):
    def symbols(text):
        return "\x01" * 3 + re.sub("[0-9]", "0", re.sub(r"[\t\n\r\x0b\x0c\xa0]", " ", text))

    got = quality.judge(documents(spark), labels(spark), quality.QualityParams(shard=20_000)).collect()
    assert {r.doc_id for r in got} == set(EXPECTED)
    rows = {(r[0], r[1]): r for r in hazards()}
    by_lang = defaultdict(list)
    for r in hazards():
        if r[0] in (1, 5, 11, 12, 13, 14, 15):
            by_lang[r[2]].append(symbols(r[1]))
    models = {lang: brute_force_model(t) for lang, t in by_lang.items()}
    models["*"] = brute_force_model([t for ts in by_lang.values() for t in ts])
    checked = 0
    found = {(r.doc_id, r.symbols): r for r in got}
    for (d, text), row in rows.items():
        r = found[d, len(text or "")]
        assert r.model == (row[2] if row[2] in by_lang else "*")
        if not text:
            assert r.perplexity is None and r.kept
            continue
        s, p = symbols(text), models[r.model]
        want = math.exp(-sum(math.log(p(s[i : i + 4])) for i in range(len(s) - 3)) / (len(s) - 3))
        assert r.perplexity == pytest.approx(want, rel=1e-4)
        checked += 1
    assert checked > 15
    assert quality.judge(none(spark), labels(spark)).count() == 0
    nothing = quality.judge(documents(spark), labels(spark).where("false")).collect()
    assert all(r.perplexity is None and r.kept for r in nothing)


def prose(n, seed, letters="abcdeiorst"):
    import random

    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(400)]
    return [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(n)]


def test_few_trusted_documents_reject_no_clean_ones(spark):
    """Thresholds come from models that did not see the text, so unseen clean text passes."""
    texts = prose(60, 1) + ["#@ %% QQ&&! ^^" * 20]
    docs = documents(spark, [(i, t, "es", "a", 0) for i, t in enumerate(texts)])
    for trusted in (3, 30):
        marks = spark.createDataFrame([(i, 1, 0) for i in range(trusted)], "doc_id long, quality int, toxic int")
        got = {r.doc_id: r for r in quality.judge(docs, marks).collect()}
        assert len(got) == len(texts)
        assert sum(got[i].kept for i in range(60)) >= 58
        if trusted == 30:
            assert not got[60].kept


def test_documents_without_a_language_of_their_own(spark):
    """Null language is held against the pooled model; a language without trusted text has no threshold."""
    rows = [(i, t, "es", "a", 0) for i, t in enumerate(prose(100, 1))]
    rows += [(100 + i, t, "de", "a", 0) for i, t in enumerate(prose(15, 2, "fghklmnpqu"))]
    trusted = [(i, 1, 0) for i in (*range(50), *range(100, 110))]
    rows = [(*r[:2], r[2] if r[0] < 50 or 100 <= r[0] < 110 else None, *r[3:]) for r in rows]
    rows += [(200 + i, t, "xx", "a", 0) for i, t in enumerate(prose(10, 3, "vwyzjxäöü"))]
    rows.append((300, "#@ %% QQ&&! ^^" * 20, None, "a", 0))
    marks = spark.createDataFrame(trusted, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judge(documents(spark, rows), marks).collect()}
    assert len(got) == len(rows)
    assert all(got[200 + i].kept and got[200 + i].threshold is None and got[200 + i].perplexity for i in range(10))
    unknown = [got[r[0]] for r in rows if r[2] is None and r[0] != 300]
    assert len(unknown) == 55 and sum(r.kept for r in unknown) >= 53
    assert got[300].threshold is not None and not got[300].kept


def test_added_tokens_are_encoded_like_the_tokenizer_does():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from partload.llm.common import text_bytes

    path = tokenizer_file("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    texts = ["end of one.<|endoftext|>Next", "<|endoftext|>", "a  <|endoftext|>\n b <|endoftext|><|endoftext|> c",
             "<|endof", "text|> <|endoftext |>", "x<|endoftext|", "> one é<|endoftext|>é two", "", "<<|endoftext|>>", "end of one. Next"]
    encode = packing.CachedTokenizer(path)
    for _ in range(2):
        ids, ends = encode(*text_bytes(pa.array(texts)))
        for i, text in enumerate(texts):
            assert ids[ends[i] : ends[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_training_takes_all_trusted_documents(spark, monkeypatch):
    """The join with the labels neither thins them nor asks for a broadcast."""
    from pyspark.sql import functions

    hinted = []
    monkeypatch.setattr(functions, "broadcast", lambda df: hinted.append(df.columns) or df)
    quality.score(documents(spark), labels(spark))
    assert not hinted and not hasattr(quality.QualityParams(), "max_trusted")


def test_copies_of_a_row_give_their_spans_once(spark):
    text = prose(1, 5)[0]
    rows = [(None, text, "en", "a", 0)] * 40 + [(7, text, "en", "a", 0)] * 40
    got = substring.repeats(documents(spark, rows), substring.RepeatParams(window=35)).collect()
    assert {r.doc_id for r in got} == {-1, 7} and all(len(r.spans) == len(set(r.spans)) for r in got)


def test_registered_packing_weighs_every_residual():
    import numpy as np

    lengths = np.random.default_rng(2).integers(1, 2049, 2000)
    scalar = packing.best_fit(lengths, packing.PackParams(weights=(1.0, 0.0, 0.0)))
    assert all(packing.PackParams().weights)
    assert packing.best_fit(lengths, packing.PackParams()).max() <= scalar.max() + 1
