"""Links counted at both ends, records a strict reader takes, and columns with the operators' own names."""

import io
import uuid
from collections import Counter

import numpy as np
import pytest

from partload.llm import mixing, vectors, warc


def test_links_are_counted_at_both_ends(spark):
    """Pairs at a cosine of 0.951, some with copies: an end that does not visit the other's list has its link too."""
    rng = np.random.default_rng(9)
    left = rng.normal(size=(1500, 64))
    left /= np.linalg.norm(left, axis=1, keepdims=True)
    off = rng.normal(size=left.shape)
    off -= (off * left).sum(axis=1, keepdims=True) * left
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    both = np.concatenate([left, 0.951 * left + np.sqrt(1 - 0.951**2) * off, left[:200]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(both)], "vec_id long, embedding array<double>")
    params = vectors.VectorParams(per_list=12, margin=0.02)
    got = {r.vec_id: r for r in vectors.near_vectors(df, params).collect()}
    want = Counter(np.nonzero((both @ both.T >= 0.95) & ~np.eye(len(both), dtype=bool))[0].tolist())
    assert all(r.n_links <= want[i] for i, r in got.items())
    for i in range(1500):
        copies = i < 200
        assert got[i].n_links - copies == got[1500 + i].n_links / (1 + copies)
    narrow = sum(got[i].n_links for i in range(1500, 3000))
    assert 0.5 * 1700 < narrow < 1700, "the narrow margin is to leave some pairs to one end"
    wide = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    assert sum(r.n_links for r in wide.values()) >= 0.99 * sum(want.values())
    assert all(wide[i].component_id == wide[1500 + i].component_id for i in range(1500) if wide[1500 + i].n_links)


def test_lists_of_the_other_end():
    lists = [np.array(x, np.int32).tobytes() for x in ((3, 7), (), (9,))]
    column, table = vectors._returned(lists, np.array([7, 9, 7, 1]))
    assert table[:, column].tolist() == [[True, False, True, False], [False] * 4, [False, True, False, False]]


def test_records_have_ids_of_their_own(spark):
    pages = [(1, "a", "same"), (1, "a", "same"), (2, "b", "same"), (3, "c", "once"), (4, "d", "once"), (None, "e", "once"),
             (None, "e", "once"), (5, "f", "one"), (5, "f", "one")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder = warc.storage.scratch_dir(spark)
    archives = warc.write_pages(df, folder, warc.WarcParams(archive_bytes=900, revisit_bytes=4)).collect()
    seen = []
    for row in archives:
        system, place = warc._open(row.archive)
        seen += [f for _, f, _ in warc.read_archive(system.open_input_stream(place).read())]
    ids = [f["WARC-Record-ID"] for f in seen]
    assert len(ids) == len(set(ids)) == len(pages) + len(archives)
    for f in seen:
        uuid.UUID(f["WARC-Record-ID"][len("<urn:uuid:") : -1])
        assert {"WARC-Type", "WARC-Date", "Content-Type", "Content-Length"} <= set(f)
    revisits = {f["X-Page-ID"]: f for f in seen if f["WARC-Type"] == "revisit"}
    assert set(revisits) == {"2", "4"}
    target = next(f for f in seen if f.get("X-Page-ID") == "3")
    assert revisits["4"]["WARC-Refers-To"] == target["WARC-Record-ID"]
    assert "WARC-Refers-To" not in revisits["2"]


def test_archive_names_itself():
    out = io.BytesIO()
    warc.write_archive([], out, warc.WarcParams(), "s3://b/c/one.warc.zst")
    ((_, fields, _),) = warc.read_archive(out.getvalue())
    assert (fields["WARC-Type"], fields["WARC-Filename"]) == ("warcinfo", "one.warc.zst")


CLASHING = ("__doc", "__fp", "__row", "__n", "__kept", "__spans", "__group", "other_1", "other_6", "fp", "kept")


def _clashing(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"{long} end {i}" if i % 2 else f"text {i} of its own words here", "en", "s") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.select("*", *[docs.doc_id.cast("string").alias(c) for c in CLASHING])


def test_mix_keeps_columns_with_its_own_names(spark):
    docs = _clashing(spark)
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert rows and all(str(r.doc_id) == r[c] for r in rows for c in CLASHING)


@pytest.mark.parametrize("stage", ["near_duplicates", "repeated_passages"])
def test_stages_keep_columns_with_their_own_names(spark, sf_dir, stage):
    import corpus_pipeline

    docs = _clashing(spark)
    got = getattr(corpus_pipeline, stage)(spark, docs.withColumn("n_chars", docs.doc_id), sf_dir)
    rows = got.collect()
    assert rows and got.columns == [*docs.columns, "n_chars"]
    assert all(str(r.doc_id) == r[c] for r in rows for c in CLASHING)
