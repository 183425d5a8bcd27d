"""A training corpus from `documents` in stages; each stage reads what its predecessor wrote."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from partload.llm import minhash, mixing, packing, quality, substring
from partload.llm.common import fingerprint, plain_names, read
from partload.llm.queries import tokenizer_file
from partload.sources import storage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_NO_ID = -(1 << 63)
_DOCUMENT = ("doc_id", "source", "lang", "text", "n_chars")


def _any_names(stage: Stage) -> Stage:
    """The stage, with columns beside those of documents called what they may: they are carried under names
    that no stage uses."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(spark, plain_names(docs, _DOCUMENT), sf_dir).toDF(*docs.columns)

    return run


def _keyed(df: DataFrame) -> DataFrame:
    """Adds __doc, which joins where doc_id is null too."""
    return df.withColumn("__doc", F.coalesce("doc_id", F.lit(_NO_ID)))


@_any_names
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is above the threshold of their language go."""
    judged = quality.judge(docs, read(spark, sf_dir, "labels"))
    bad = _keyed(judged.where("NOT kept")).select("__doc", F.col("fp").alias("__fp"))
    keyed = _keyed(docs).withColumn("__fp", fingerprint())
    return keyed.join(bad, ["__doc", "__fp"], "left_anti").select(docs.columns)


@_any_names
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each group stays, the one with the smallest id; a null id only where no row has one.

    Rows that repeat an id and its text are one; texts of one id, or of none, are documents of their own.
    """
    row = F.xxhash64(F.coalesce("doc_id", F.lit(_NO_ID)), F.coalesce("text", F.lit("")))
    keyed = docs.withColumn("__row", row)
    groups = minhash.near_duplicates(keyed.select(F.col("__row").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group")).distinct()
    placed = groups.join(keyed.select("__row", "doc_id").distinct(), "__row")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).alias("__first")
    first = placed.groupBy("__group").agg(first).select("__first.__row")
    one = Window.partitionBy("__row").orderBy("text")
    left = keyed.join(first, "__row", "left_semi").withColumn("__n", F.row_number().over(one))
    return left.where("__n = 1").select(docs.columns)


@_any_names
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages of 50 words or more that occur twice go; other texts stay as they are."""
    cut = substring.remove_repeats(docs).where("n_removed > 0")
    cut = _keyed(cut).select("__doc", F.col("fp").alias("__fp"), F.col("kept_text").alias("__kept"))
    keyed = _keyed(docs).withColumn("__fp", fingerprint())
    text = F.coalesce("__kept", "text")
    joined = keyed.join(cut.dropDuplicates(["__doc", "__fp"]), ["__doc", "__fp"], "left")
    return joined.withColumns({"text": text, "n_chars": F.length(text).cast("long")}).select(docs.columns)


@_any_names
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares; a document taken twice is two rows."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("good_quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixed_sources", mixed_sources),
    ("packed_sequences", packed_sequences),
]

# The perplexity, the permutations and the tokens cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's result is written; its other scratch tables, and its input, are then given back."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        folder = storage.scratch_dir(spark)
        with storage.scratch_scope(spark):
            docs = storage.materialise(stage(spark, docs, sf_dir), name, folder)
        if before:
            storage.delete_prefix(spark, before)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
