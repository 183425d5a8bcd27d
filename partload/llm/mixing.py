"""Mixing sources to target weights in fixed-length blocks.

The words of each source's documents, one after the other in a pseudorandom order, are cut into
blocks of equal length. A mix is a number of slots, each holding one block. For every output shard
the numbers of slots its sources fill are drawn from a multinomial distribution; what the draws of a
source sum to above or below its quota is cut from the last shards or put into shards of its own, so
the totals are exact. The k-th slot of a source holds the block that a keyed permutation of the
source's block numbers gives k in its round, so a source is used up before it repeats. Blocks are
joined to slots by number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partload.llm.common import WORD, Words, dense_index, mix64, plain_names, running_total, slices, spread, text_bytes
from partload.sources import storage

_U = np.uint64


@dataclass(frozen=True)
class MixParams:
    """`weights` of the sources in code-point order, repeating; `share` of all words to take.

    No source gives more than `ceiling` times its words. `max_sources` bounds the draw vector sent
    to the tasks (8 bytes a source); with more sources the mix is refused.
    """

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    ceiling: float = 2.0
    block_words: int = 64
    shard_slots: int = 4096
    seed: int = 17
    max_sources: int = 1_000_000


@dataclass(frozen=True)
class Mix:
    """`rows`: doc_id, fp, source, size and the place of each row in its source's words.
    `sources`: words, blocks, target and quota of each source. `slots`: shard, slot, block."""

    rows: DataFrame
    sources: DataFrame
    slots: DataFrame
    block_words: int


_NO_ID = -(1 << 63)


def _fingerprint() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")), F.coalesce("source", F.lit("")))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of range(size), at index: four Feistel rounds, walking cycles.

    Works element by element; index < size, and elements with equal size and key share one
    permutation.
    """
    half = np.array([max(1, (int(s - 1).bit_length() + 1) // 2) for s in size.tolist()], dtype=_U)
    mask = (_U(1) << half) - _U(1)
    value, key = index.astype(_U), key.astype(_U)
    todo = np.ones(len(value), dtype=bool)
    while todo.any():
        v, h, m, k = value[todo], half[todo], mask[todo], key[todo]
        left, right = v >> h, v & m
        for turn in range(4):
            left, right = right, left ^ (mix64(right + k * _U(2 * turn + 3)) & m)
        value[todo] = (left << h) | right
        todo[todo] = value[todo] >= size[todo].astype(_U)
    return value.astype(np.int64)


def _targets(rows: DataFrame, params: MixParams) -> DataFrame:
    """One row for each source: rank, words, weight, target, blocks and quota of slots.

    The level at which weight * level or the ceiling sums to the share is found by counting, round
    by round, what the sources at their ceiling hold; only sums reach the driver.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Nulls last: they have no place among the others.
    sources = sources.withColumn("_null", F.col("source").isNull().cast("int"))
    ranked = dense_index(sources, ["_null", "source"], "rank").drop("_null")
    weights = F.array(*[F.lit(w) for w in params.weights])
    ranked = storage.materialise(
        ranked.withColumn("weight", F.get(weights, F.pmod("rank", F.lit(len(params.weights))).cast("int"))),
        "sources",
    )
    most = params.ceiling * F.col("source_size")

    def sums(where: F.Column) -> tuple[int, int]:
        row = ranked.where(where).agg(F.sum("source_size"), F.sum("weight")).first()
        return row[0] or 0, row[1] or 0

    words, weight = sums(F.lit(True))
    level, full, heavy = 0.0, -1, -1
    while True:
        held = sums(most <= F.lit(level) * F.col("weight")) if full >= 0 else (0, 0)
        if held == (full, heavy) or weight == held[1]:
            break
        full, heavy = held
        level = (params.share * words - params.ceiling * full) / (weight - heavy)
    target = F.least(most, F.lit(level) * F.col("weight")) if words else F.lit(0.0)
    if words and weight == held[1]:
        target = most
    blocks = F.ceil(F.col("source_size") / params.block_words)
    quota = F.when(
        F.col("source_size") > 0, F.round(F.col("target") * F.col("blocks") / F.col("source_size"))
    ).otherwise(0)
    return storage.materialise(
        ranked.withColumn("target", target.cast("double"))
        .withColumn("blocks", blocks.cast("long"))
        .withColumn("quota", quota.cast("long")),
        "targets",
    )


def _draws(chances: np.ndarray, slots: int, seed: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                drawn = np.random.default_rng([seed, shard]).multinomial(slots, chances)
                rank = np.flatnonzero(drawn)
                yield pd.DataFrame({"shard": shard, "rank": rank, "n": drawn[rank]})

    return run


def _slots(seed: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 256):
                part = frame.iloc[at : at + 256]
                n = part["n"].to_numpy()
                row = np.repeat(np.arange(len(part)), n)
                k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + part["ahead"].to_numpy()[row]
                size = part["blocks"].to_numpy()[row]
                turn, index = k // size, k % size
                key = mix64(
                    part["key"].to_numpy().astype(np.int64).view(_U)[row] + _U(seed) + turn.astype(_U)
                )
                yield pd.DataFrame(
                    {
                        "shard": part["shard"].to_numpy()[row],
                        "rank": part["rank"].to_numpy()[row],
                        "slot": k,
                        "turn": turn,
                        "block": permuted(index, size, key),
                    }
                )

    return run


def mix(docs: DataFrame, params: MixParams = MixParams()) -> Mix:
    """Plan a mix of docs (doc_id, source, text).

    Sizes are words; null text has none. A null source is a source. Null and repeated ids are rows
    of their own. Without words the mix is empty. Other columns of docs are not looked at.
    """
    spark = docs.sparkSession
    sized = docs.select(
        "doc_id",
        "source",
        _fingerprint().alias("fp"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    sized = storage.materialise(sized, "sized")
    sources = _targets(sized, params)
    buckets = spread(sized.count(), 4096)
    dealt = sized.withColumn(
        "bucket", F.pmod(F.xxhash64(F.lit(params.seed), "doc_id", "fp"), F.lit(buckets))
    )
    known = sources.select(
        F.col("source").alias("_source"), "rank", "source_size", "target", "blocks", "quota"
    )
    dealt = dealt.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = running_total(dealt, ["rank"], "bucket", ["doc_id", "fp"], "size", "start").drop("bucket")
    rows = storage.materialise(rows, "rows")

    quotas = sources.select("rank", "quota").where("quota > 0")
    total = quotas.agg(F.sum("quota"), F.count(F.lit(1)), F.max("rank")).first()
    if (total[1] or 0) > params.max_sources:
        raise ValueError(f"more than {params.max_sources} sources")
    chances = np.zeros((total[2] or 0) + 1)
    for row in quotas.toLocalIterator():
        chances[row["rank"]] = row["quota"]
    chances = chances / max(chances.sum(), 1)
    shards = spread(total[0] or 0, params.shard_slots)
    slots = params.shard_slots if total[0] else 0
    draws = spark.range(shards).mapInPandas(
        _draws(chances, slots, params.seed), "shard long, rank long, n long"
    )
    draws = storage.materialise(draws, "draws")
    counted = running_total(
        draws.withColumn("range", F.floor(F.col("shard") / 4096)), ["rank"], "range", ["shard"], "n", "ahead"
    ).drop("range")
    held = counted.join(sources.select("rank", "quota", "blocks", "source"), "rank").withColumn(
        "n", F.least("quota", F.col("ahead") + F.col("n")) - F.least("quota", "ahead")
    )
    drawn = draws.groupBy("rank").agg(F.sum("n").alias("drawn"))
    short = (
        sources.select("rank", "quota", "blocks", "source").join(drawn, "rank", "left")
        .withColumn("ahead", F.coalesce("drawn", F.lit(0)))
        .withColumn("n", F.col("quota") - F.col("ahead"))
        .withColumn("shard", F.lit(shards) + F.pmod("rank", F.lit(shards)))
    )
    columns = ["shard", "rank", "ahead", "n", "blocks", F.xxhash64("source").alias("key")]
    filled = held.select(*columns).unionByName(short.select(*columns)).where("n > 0")
    planned = filled.mapInPandas(
        _slots(params.seed), "shard long, rank long, slot long, turn long, block long"
    )
    return Mix(rows, sources, planned, params.block_words)


def parts(plan: Mix) -> DataFrame:
    """The pieces of documents that blocks hold: rank, block, start, word, words.

    `start` is the place of the document in its source; `word` the first word within the document.
    """
    size = plan.block_words
    end = F.col("start") + F.col("size")
    first, last = F.floor(F.col("start") / size), F.floor((end - 1) / size)
    low, high = F.greatest("start", F.col("block") * size), F.least(end, (F.col("block") + 1) * size)
    return (
        plan.rows.where("size > 0")
        .select("rank", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
        .select("rank", "block", "start", (low - F.col("start")).alias("word"), (high - low).alias("words"))
    )


def words_taken(plan: Mix) -> DataFrame:
    """(doc_id, fp, size, source, source_size, target, taken), one row for each row of docs."""
    times = plan.slots.groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = (
        parts(plan).join(times, ["rank", "block"])
        .groupBy("rank", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    key = F.when(F.col("size") > 0, F.col("start")).alias("start")
    rows = plan.rows.withColumn("start", key)
    return rows.join(taken, ["rank", "start"], "left").select(
        "doc_id", "fp", "size", "source", "source_size", "target",
        F.coalesce("taken", F.lit(0)).alias("taken"),
    )


def spans_taken(plan: Mix) -> DataFrame:
    """(doc_id, fp, turn, spans): the word spans each turn of the mix takes of a document."""
    taken = (
        plan.slots.select("rank", "block", "turn").join(parts(plan), ["rank", "block"])
        .groupBy("rank", "start", "turn")
        .agg(F.sort_array(F.collect_list(F.struct("word", "words"))).alias("spans"))
    )
    return plan.rows.where("size > 0").join(taken, ["rank", "start"]).select(
        "doc_id", "fp", "size", "turn", "spans"
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts shortened to their spans; a span is cut out of the text as it stands there."""
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = text_bytes(part.column("text"))
            words, raw = Words(data, offsets), data.tobytes()
            out = []
            for i, spans in enumerate(part.column("__spans").to_pylist()):
                first, n = int(words.first[i]), int(words.first[i + 1] - words.first[i])
                runs: list[list[int]] = []
                for span in spans:
                    if runs and runs[-1][1] == span["word"]:
                        runs[-1][1] += span["words"]
                    else:
                        runs.append([span["word"], span["word"] + span["words"]])
                if runs == [[0, n]]:
                    out.append(raw[offsets[i] : offsets[i + 1]].decode())
                else:
                    cut = [raw[words.start[first + a] : words.end[first + b - 1]] for a, b in runs]
                    out.append(b" ".join(cut).decode())
            at = part.schema.get_field_index("text")
            yield part.set_column(at, "text", pa.array(out, pa.string())).drop_columns(["__spans"])


def mixed_documents(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """The mix as documents with the columns of docs: one row for each document and turn it is taken in.

    The text of a row is what the turn takes of it, the whole text where it takes all words; n_chars,
    if there is such a column, follows. Documents without words are not in a mix. Rows that agree
    in id, source and text take their other columns from one of them, whatever those are called.
    """
    names = docs.columns
    docs = plain_names(docs, ("doc_id", "source", "text", "n_chars"))
    plan = mix(docs, params)
    spans = spans_taken(plan).select(
        F.coalesce("doc_id", F.lit(_NO_ID)).alias("__doc"), F.col("fp").alias("__fp"), F.col("spans").alias("__spans")
    )
    keyed = docs.withColumn("__doc", F.coalesce("doc_id", F.lit(_NO_ID))).withColumn("__fp", _fingerprint())
    one = Window.partitionBy("__doc", "__fp").orderBy("__doc", "__fp")
    texts = keyed.withColumn("__n", F.row_number().over(one)).where("__n = 1").drop("__n")
    taken = texts.join(spans, ["__doc", "__fp"]).select(*docs.columns, "__spans")
    out = taken.mapInArrow(_cut, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.toDF(*names)
