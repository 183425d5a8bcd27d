"""The registered queries against their SQL, and the pipeline."""

import compare
import corpus_pipeline
import pytest
from fixtures import documents, labels, none

from partload.llm import queries
from partload.sources import storage

PYTHON = ("MapInArrow", "MapInPandas", "EvalPython", "FlatMapGroups", "ExistingRDD")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    same, message = compare.compare(queries.QUERIES[name](spark, sf_dir), compare.connect(sf_dir), queries.ORACLES[name])
    assert same, message


@pytest.mark.parametrize("name", ["op1_linked_quotations", "op7_document_fingerprints"])
def test_native_queries_run_no_python(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().toString()
    assert not [word for word in PYTHON if word in plan]
    assert df.count() > 0


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = storage.materialise(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        if name != "mixed_sources":
            assert docs.count() <= before
            before = docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


@pytest.mark.parametrize("make", [documents, none])
def test_stages_take_every_hazard(spark, tmp_path, make):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = storage.materialise(stage(spark, docs, str(tmp_path)), name)
    assert (docs.count() > 0) == (make is documents)


def test_near_duplicates_work_on_texts_not_ids(spark):
    texts = [" ".join(f"{c}{i}" for i in range(80)) for c in "abcd"]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[0]), (None, texts[2]), (None, f"{texts[2]} z"), (None, texts[3]),
            (5, texts[3]), (5, texts[3])]
    docs = documents(spark, [(i, t, "en", "a", None) for i, t in rows])
    out = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    got = sorted((r.doc_id or 0, r.text[0]) for r in out)
    assert got == [(0, "c"), (1, "a"), (1, "b"), (5, "d")]
