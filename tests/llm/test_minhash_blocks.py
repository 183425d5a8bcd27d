"""Many short texts with a common opening: blocks stay small, and nothing links that should not."""

from pyspark.sql import functions as F

from partload.llm import minhash


def test_short_texts_with_a_common_opening(spark):
    docs = spark.range(4_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("common opening words w"), F.col("id").cast("string")).alias("text")
    )
    copies = docs.where("doc_id < 3").select((F.col("doc_id") + 10_000).alias("doc_id"), "text")
    out = minhash.near_duplicates(docs.union(copies), minhash.NearParams(shingle=3, percent=85, members=300))
    assert out.count() == 4_003
    assert sorted(r.doc_id for r in out.where("NOT kept").collect()) == [10_000, 10_001, 10_002]
