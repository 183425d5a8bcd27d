"""Document quality by the perplexity of an interpolated modified Kneser-Ney n-gram model.

The model predicts characters (white space is one symbol, digits are one) from the three before
them, with one model for each language, trained on all trusted documents. Characters keep the number
of distinct n-grams low against the text, and shouting, symbol noise and broken words are what a
model of characters finds improbable.

1. One pass lists the distinct n-grams of all texts, one counts those of the trusted texts by fold;
   both are summed within a task before they are shuffled.
2. The probability of every listed n-gram comes from joins of the count tables of each order, sharded
   by n-gram: discounted count over context count, and the context's remaining weight times the
   probability of the shorter n-gram.
3. Resolved n-grams are cut into shards of bounded size. Each shard is sent to the tasks, which add up
   the log probabilities of its n-grams in every document; the sums of the shards are added. So what is
   broadcast does not grow with the corpus.
4. Trusted texts are dealt to folds by a hash of the text, so exact copies share one. Each fold is also
   scored by models without its counts, with steps 2 and 3.
5. A document is rejected if its perplexity is above a quantile of these held-out perplexities of its
   language. Where they are too few for the quantile, the threshold is at least the bound that
   Student's t puts on one more of their logarithms; one alone gives no threshold.
6. A document of unknown language is held against the trusted documents of every language, scored by a
   held-out model of all: the threshold is the quantile of all or of one language, whichever is largest. A
   language without trusted text has no threshold: its documents have a perplexity and are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partload.llm.common import fingerprint, mix64, slices, spread, text_bytes
from partload.sources import storage

_U = np.uint64
ORDER = 4
_START = 1
POOLED = "*"


@dataclass(frozen=True)
class QualityParams:
    """`quantile` of the held-out trusted perplexities that is still accepted, and `slack` above it.

    `shard` bounds the n-grams sent to the tasks at once, at 16 bytes each. `folds`: 2 to 10.
    """

    quantile: float = 0.995
    slack: float = 1.0
    shard: int = 2_000_000
    folds: int = 5


def _characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each behind three start symbols, and the n + 1 offsets."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    points = points.copy()
    points[((points >= 9) & (points <= 13)) | (points == 0xA0)] = 32
    points[(points >= 48) & (points <= 57)] = 48
    text = np.searchsorted(heads, np.arange(len(points)), side="right") - 1
    out = np.full(len(points) + 3 * (len(offsets) - 1), _START, dtype=np.uint32)
    out[np.arange(len(points)) + 3 * (text + 1)] = points
    return out, heads + 3 * np.arange(len(offsets))


# Odd multipliers, one for each place of an n-gram.
_PLACES = mix64(np.arange(11, 11 + ORDER, dtype=_U)) | _U(1)


def _gram_keys(points: np.ndarray) -> np.ndarray:
    """64 bits for the n-gram that starts at each place."""
    n = len(points) - ORDER + 1
    wide = points.astype(_U)
    key = wide[:n] * _PLACES[0]
    for i in range(1, ORDER):
        key += wide[i : i + n] * _PLACES[i]
    return key


def _starts(bounds: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Places where a whole n-gram of one of these texts starts."""
    counts = (np.diff(bounds) - ORDER + 1)[texts]
    ends = np.cumsum(counts)
    return np.repeat(bounds[texts] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


class _Counter:
    """n-grams of one model met so far in a task, with their counts."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.size, self.limit = 0, 500_000

    def add(self, keys: np.ndarray, counts: np.ndarray, grams: np.ndarray) -> None:
        self.parts.append((keys, counts, grams))
        self.size += len(keys)
        if self.size > self.limit:
            self.merge()
            self.limit = max(500_000, 2 * self.size)

    def merge(self) -> tuple:
        keys = np.concatenate([p[0] for p in self.parts])
        counts = np.concatenate([p[1] for p in self.parts])
        grams = np.concatenate([p[2] for p in self.parts])
        keys, first, which = np.unique(keys, return_index=True, return_inverse=True)
        merged = keys, np.bincount(which, counts, len(keys)).astype(np.int64), grams[first]
        self.parts, self.size = [merged], len(keys)
        return merged


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, _Counter] = {}

    def emit(name: str) -> Iterator[pa.RecordBatch]:
        _, counts, grams = found.pop(name).merge()
        text = grams.astype("<u4").tobytes().decode("utf-32-le")
        for at in range(0, len(counts), 100_000):
            rows = range(at, min(at + 100_000, len(counts)))
            yield pa.record_batch(
                {
                    "model": pa.array([name] * len(rows), pa.string()),
                    "gram": pa.array([text[ORDER * i : ORDER * i + ORDER] for i in rows], pa.string()),
                    "n": pa.array(counts[rows.start : rows.stop]),
                }
            )

    for batch in batches:
        for part in slices(batch, "text"):
            points, bounds = _characters(*text_bytes(part.column("text")))
            if len(points) < ORDER:
                continue
            keys = _gram_keys(points)
            names = part.column("model").to_pylist()
            for name in set(names):
                own = np.array([x == name for x in names])
                places = _starts(bounds, np.flatnonzero(own))
                if not len(places):
                    continue
                unique, first, n = np.unique(keys[places], return_index=True, return_counts=True)
                at = places[first]
                grams = np.stack([points[at + i] for i in range(ORDER)], axis=1)
                found.setdefault(name, _Counter()).add(unique, n, grams)
            while sum(c.size for c in found.values()) > 1_500_000:
                yield from emit(max(found, key=lambda name: found[name].size))
    for name in list(found):
        yield from emit(name)


def _discounted(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Discounted counts (model, gram, part), and each context's (model, context, total, rest).

    The discounts of counts 1, 2 and 3 or more come from the numbers of n-grams counted once to
    four times; where those do not give a discount between 0 and the count, half the count is taken.
    """
    tallies = counts.groupBy("model").agg(
        *[F.count(F.when(F.col("n") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]
    )
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def discount(i: int) -> Column:
        value = i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
        good = (F.col("n1") > 0) & (value > 0) & (value < i)
        return F.when(good, value).otherwise(i / 2).alias(f"d{i}")

    rates = tallies.select("model", *[discount(i) for i in (1, 2, 3)])
    d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    parts = counts.join(rates, "model").select(
        "model", "gram", "n", d.alias("d"), F.expr("left(gram, length(gram) - 1)").alias("context")
    )
    contexts = parts.groupBy("model", "context").agg(
        F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("rest")
    )
    return parts.select("model", "gram", (F.col("n") - F.col("d")).alias("part")), contexts


def probabilities(grams: DataFrame, counted: DataFrame) -> DataFrame:
    """(model, gram, p) for every row of grams (model, gram), from the counts (model, gram, n).

    Models without any count have no probabilities and no rows here.
    """
    known = storage.materialise(counted, "counts")
    models = known.select("model").distinct()
    wanted = {ORDER: grams.join(models, "model", "left_semi").select("model", "gram")}
    counts = {ORDER: known}
    for k in range(ORDER - 1, 0, -1):
        tail = F.expr("right(gram, length(gram) - 1)").alias("gram")
        # Written, or each order would deal out the longer n-grams anew.
        wanted[k] = storage.materialise(wanted[k + 1].select("model", tail).distinct(), f"wanted{k}")
        # How many different characters stand before the shorter n-gram.
        counts[k] = counts[k + 1].groupBy("model", tail).agg(F.count(F.lit(1)).alias("n"))
        counts[k] = storage.materialise(counts[k], f"counts{k}")
    p = None
    for k in range(1, ORDER + 1):
        parts, contexts = _discounted(counts[k])
        out = wanted[k].withColumn("context", F.expr(f"left(gram, {k - 1})"))
        out = out.join(parts, ["model", "gram"], "left").join(contexts, ["model", "context"], "left")
        seen = F.coalesce(F.col("part") / F.col("total"), F.lit(0.0))
        if p is None:
            sizes = counts[1].groupBy("model").agg((F.count(F.lit(1)) + 1).alias("symbols"))
            out = out.join(sizes, "model")
            lower = 1 / F.col("symbols")
        else:
            out = out.withColumn("tail", F.expr(f"right(gram, {k - 1})")).join(
                p.select("model", F.col("gram").alias("tail"), F.col("p").alias("lower")),
                ["model", "tail"],
            )
            lower = F.col("lower")
        p = out.select(
            "model", "gram", (seen + F.coalesce("rest", F.lit(1.0)) * lower).alias("p")
        )
        p = storage.materialise(p, f"p{k}")
    return p


class Shard:
    """Log probabilities by n-gram in an open hash table."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys = np.zeros(size, dtype=_U)
        self.values = np.full(size, np.nan, dtype=np.float32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = np.isnan(self.values[slot])
            self.values[slot[free]] = values[left[free]]
            self.keys[slot[free]] = keys[left[free]]
            lost = (self.keys[slot] != keys[left]) | np.isnan(self.values[slot])
            left, slot = left[lost], (slot[lost] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, NaN where there is none."""
        slot = self._slot(keys)
        out = self.values[slot]
        todo = np.flatnonzero((self.keys[slot] != keys) & ~np.isnan(out))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & (len(self.keys) - 1)
            out[todo] = self.values[slot]
            miss = (self.keys[slot] != keys[todo]) & ~np.isnan(out[todo])
            todo, slot = todo[miss], slot[miss]
        return out


def _model_key(name: str | None) -> int:
    import zlib

    return int(mix64(np.array([zlib.crc32((name or "").encode())], dtype=_U))[0])


def _scored(shard):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shard.value
        for batch in batches:
            for part in slices(batch, "text"):
                points, bounds = _characters(*text_bytes(part.column("text")))
                rows = part.num_rows
                total, n = np.zeros(rows), np.diff(bounds) - ORDER + 1
                if len(points) >= ORDER:
                    start, text = _starts(bounds, np.arange(rows)), np.repeat(np.arange(rows), n)
                    names = part.column("model").to_pylist()
                    salt = {name: _model_key(name) for name in set(names)}
                    own = np.array([salt[x] for x in names], dtype=_U)
                    found = table.get(_gram_keys(points)[start] + own[text])
                    total = np.bincount(text, np.nan_to_num(found, nan=0.0), rows)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "fp": part.column("fp"),
                        "lang": part.column("lang"),
                        "model": part.column("model"),
                        "log_p": pa.array(total),
                        "symbols": pa.array(n.astype(np.int64)),
                    }
                )

    return run


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The table key of each n-gram, made in the tasks, so that the driver meets numbers only."""
    for batch in batches:
        text = "".join(batch.column("gram").to_pylist())
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).reshape(-1, ORDER).astype(_U)
        names = batch.column("model").dictionary_encode()
        salts = np.array([_model_key(x) for x in names.dictionary.to_pylist()], dtype=_U)
        keys = (points * _PLACES).sum(axis=1, dtype=_U)
        if len(keys):
            keys = keys + salts[names.indices.to_numpy()]
        yield pa.record_batch({"key": pa.array(keys.view(np.int64)), "log_p": batch.column("log_p")})


def _perplexities(texts: DataFrame, by: list[str | Column], resolved: DataFrame, params: QualityParams) -> DataFrame:
    """(*by, model, symbols, perplexity), `by` of doc_id, fp, lang, of texts (doc_id, fp, lang, model, text).

    One shard of the probabilities is sent to the tasks at a time; the sums it gives are written
    before the next one is built, and it is given back.
    """
    sc = texts.sparkSession.sparkContext
    keyed = resolved.select("model", "gram", F.ln("p").cast("float").alias("log_p"))
    keyed = storage.materialise(keyed.mapInArrow(_keyed, "key long, log_p float"), "table")
    shards = spread(keyed.count(), params.shard)
    sums = None
    for i in range(shards):
        table = keyed.where(F.pmod("key", F.lit(shards)) == i).toArrow()
        shard = sc.broadcast(Shard(table.column("key").to_numpy().view(_U), table.column("log_p").to_numpy()))
        del table
        part = texts.select("doc_id", "fp", "lang", "model", "text").mapInArrow(
            _scored(shard), "doc_id long, fp long, lang string, model string, log_p double, symbols long"
        )
        part = storage.materialise(part, "sums")
        shard.destroy()
        del shard
        sums = part if sums is None else sums.union(part)
    # Rows that repeat a document add as often to the sum as to the count.
    total = sums.groupBy(*by, "model").agg(
        (F.sum("log_p") * shards / F.count(F.lit(1))).alias("log_p"), F.max("symbols").alias("symbols")
    )
    perplexity = F.when((F.col("symbols") > 0) & (F.col("log_p") < 0), F.exp(-F.col("log_p") / F.col("symbols")))
    return total.withColumns({"symbols": F.col("symbols").cast("long"), "perplexity": perplexity}).drop("log_p")


def score(
    docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp, known, model, trusted, symbols, perplexity), one row for each (doc_id, text) of docs,
    and the held-out (fp, lang, model, symbols, perplexity), one row for each trusted text of a model.

    Trusted are documents labelled quality 1 and not toxic 1. A document of a language without
    trusted documents is scored by the model of all of them; null, '' and '*' are not `known`
    languages; null and '' have a model of their own where trusted texts have them. Empty
    and null texts have perplexity null. Without any trusted text there is no model and every perplexity is null.
    """
    good = labels.where("quality = 1 AND coalesce(toxic, 0) <> 1 AND doc_id IS NOT NULL")
    good = storage.materialise(good.select("doc_id").distinct(), "trusted")
    rows = docs.select("doc_id", fingerprint().alias("fp"), F.coalesce("lang", F.lit("")).alias("lang"), "text")
    fold = F.pmod("fp", F.lit(params.folds)).cast("string")
    trusted = storage.materialise(
        rows.where("text <> ''").join(good, "doc_id")
        .select("doc_id", "fp", "lang", F.col("lang").alias("model"), fold.alias("fold"), "text"),
        "texts",
    )
    # Languages with trusted text have a model of their own.
    has = trusted.select(F.col("model").alias("lang")).distinct().withColumn("has", F.lit(True))
    has = storage.materialise(has, "languages")
    chosen = F.when(F.col("has") & (F.col("lang") != POOLED), F.col("lang")).otherwise(F.lit(POOLED))
    known = ~F.col("lang").isin("", POOLED)
    marked = rows.join(has, "lang", "left").withColumn("model", chosen).withColumn("known", known)
    listed = marked.select("model", "text").mapInArrow(_counted, "model string, gram string, n long")
    listed = storage.materialise(listed.select("model", "gram").distinct(), "grams")

    # A model that does not see a fold is named by the fold's digit and the model.
    unseen = F.concat("fold", "model").alias("model")
    counts = trusted.select(unseen, "text").mapInArrow(_counted, "model string, gram string, n long")
    parts = [
        F.sum(F.when(F.expr("left(model, 1)") == str(i), F.col("n")).otherwise(0)).alias(f"fold{i}")
        for i in range(params.folds)
    ]
    counts = counts.groupBy(F.expr("substr(model, 2)").alias("name"), "gram").agg(F.sum("n").alias("n"), *parts)
    counts = storage.materialise(counts.withColumnRenamed("name", "model"), "counts")
    pooled = F.col("model") == POOLED
    own = counts.where(~pooled)
    if not listed.where(pooled).isEmpty():
        every = counts.groupBy("gram").agg(*[F.sum(c).alias(c) for c in counts.columns[2:]])
        own = own.unionByName(every.withColumn("model", F.lit(POOLED)))
    scored = _perplexities(
        marked, ["doc_id", "fp", known.alias("known")], probabilities(listed, own.select("model", "gram", "n")), params
    )
    scored = scored.join(good.withColumn("trusted", F.lit(True)), "doc_id", "left").withColumn(
        "trusted", F.coalesce("trusted", F.lit(False))
    )

    # The pooled model has a threshold only for documents of unknown language.
    asked = not marked.where(pooled & ~F.col("known")).isEmpty()
    tested = own if asked else counts.where(~pooled)
    folds = F.array(*[
        F.struct(F.lit(str(i)).alias("fold"), F.col(f"fold{i}").alias("own")) for i in range(params.folds)
    ])
    folds = tested.select("model", "gram", "n", F.inline(folds))
    left = folds.where("n > own").select(unseen, "gram", (F.col("n") - F.col("own")).alias("n"))
    resolved = probabilities(folds.where("own > 0").select(unseen, "gram"), left)
    texts = trusted.where(~pooled)
    if asked:
        texts = texts.unionByName(trusted.withColumn("model", F.lit(POOLED)))
    held = _perplexities(texts.withColumn("model", unseen), ["fp", "lang"], resolved, params)
    return scored, held.withColumn("model", F.expr("substr(model, 2)")).where("perplexity IS NOT NULL")


def _limit(params: QualityParams) -> Column:
    """The threshold that a group of held-out perplexities gives."""
    plain = F.percentile_approx("perplexity", params.quantile, 10_000)
    n = F.count("perplexity")
    z, v = NormalDist().inv_cdf(min(max(params.quantile, 1e-9), 1 - 1e-9)), n - 1
    # Fisher's series of Student's t.
    t = (
        z + F.try_divide(F.lit((z**3 + z) / 4), v)
        + F.try_divide(F.lit((5 * z**5 + 16 * z**3 + 3 * z) / 96), v**2)
        + F.try_divide(F.lit((3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384), v**3)
    )
    log_p = F.ln("perplexity")
    bound = F.exp(F.avg(log_p) + t * F.stddev_samp(log_p) * F.sqrt(1 + F.try_divide(F.lit(1), n)))
    limit = F.when(n * (1 - params.quantile) >= 1, plain).when(n > 1, F.greatest(plain, bound))
    return limit * params.slack


def judge(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """`score` with threshold and kept. Documents without a perplexity or a threshold are kept."""
    scored, held = score(docs, labels, params)
    held = storage.materialise(held, "held")
    limits = held.groupBy("model").agg(_limit(params).alias("threshold"))
    each = held.where(F.col("model") == POOLED).groupBy("model", "lang").agg(
        (F.percentile_approx("perplexity", params.quantile, 10_000) * params.slack).alias("one")
    )
    limits = limits.join(each.groupBy("model").agg(F.max("one").alias("one")), "model", "left")
    limits = limits.select(
        "model", F.when(F.col("threshold").isNotNull(), F.greatest("threshold", "one")).alias("threshold")
    )
    threshold = F.when((F.col("model") != POOLED) | ~F.col("known"), F.col("threshold"))
    # Written, so that its size is known and the join is no shuffle of all documents by model.
    limits = storage.materialise(limits, "limits")
    return scored.join(limits, "model", "left").withColumn("threshold", threshold).withColumn(
        "kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    )
