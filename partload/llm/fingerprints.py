"""Document fingerprints by invertible Bloom lookup sketches of paragraph digests.

A sketch has three tables of s cells. Each distinct paragraph digest goes into one hashed cell of
every table; a cell holds the number of its digests, their exclusive or, and that of their checks.
Sketches of equal size subtract cell by cell: what two versions share cancels out. Peeling then finds
cells that hold one digest, takes it out of its other cells, and goes on until all cells are empty;
the digests taken out are those that differ. If cells remain, both versions are sketched at double
size and peeled again.

Everything is column expressions. A paragraph is a line; longer lines are cut every `PIECE` characters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from partload.llm.common import dense_index, fingerprint, let

PIECE = 256
_NO_ID = -(1 << 63)


@dataclass(frozen=True)
class SketchParams:
    """`cells`: cells of each of the three tables of a first sketch. `rounds` of peeling at most;
    `tries` sketches, each of double size."""

    cells: int = 8
    rounds: int = 48
    tries: int = 40


def digests(text: str) -> str:
    """The distinct digests of the paragraphs of a text."""
    pieces = f"regexp_extract_all({text}, '[^\\\\n]{{1,{PIECE}}}', 0)"
    return f"array_distinct(transform({pieces}, p -> xxhash64(p)))"


def _placed(items: str, s: str) -> str:
    """Items (n, k) with their check and their cells in three tables of s cells."""
    return f"""transform({items}, d -> named_struct('n', d.n, 'k', d.k, 'c', xxhash64(d.k, 7),
        'p0', pmod(xxhash64(d.k, 1), {s}), 'p1', {s} + pmod(xxhash64(d.k, 2), {s}),
        'p2', 2 * {s} + pmod(xxhash64(d.k, 3), {s})))"""


def _cells(items: str, s: str) -> str:
    """The 3 * s cells (n, k, c) of items (n, k).

    Every item has an entry for each of its cells, the cell in the upper 32 bits and the item's number, from 1,
    in the lower. In sorted order a cell's entries follow its mark, the entry of item 0, so each is met once.
    """
    entries = [f"transform(placed, (d, i) -> shiftleft(d.p{t}, 32) + i + 1)" for t in range(3)]
    marks = f"transform(sequence(0L, 3L * {s} - 1), j -> shiftleft(j, 32))"
    at = "filter(transform(sorted, (e, i) -> IF(cast(e & 4294967295L AS int) = 0, i, NULL)), x -> x IS NOT NULL)"
    item = "placed[cast(e & 4294967295L AS int) - 1]"
    add = f"named_struct('n', a.n + {item}.n, 'k', a.k ^ {item}.k, 'c', a.c ^ {item}.c)"
    run = "slice(sorted, m + 2, IF(j + 1 = size(marked), size(sorted), marked[j + 1]) - m - 1)"
    folded = f"""transform(marked, (m, j) ->
        aggregate({run}, named_struct('n', 0, 'k', 0L, 'c', 0L), (a, e) -> {add}))"""
    body = let("sorted", f"sort_array(concat({marks}, {', '.join(entries)}))", let("marked", at, folded))
    return let("placed", _placed(items, s), body)


def sketch(keys: str, s: str) -> str:
    """The cells (n, k, c) of a set of digests."""
    return _cells(f"transform({keys}, k -> named_struct('n', 1, 'k', k))", s)


def subtract(a: str, b: str) -> str:
    return f"""zip_with({a}, {b}, (x, y) ->
        named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'c', x.c ^ y.c))"""


def peel(cells: str, s: str, rounds: int) -> str:
    """The digests of a subtracted sketch, n = 1 for those of the first; null if peeling fails."""
    # Distinct by key, not by struct, which Spark compares pairwise.
    pure = ", ".join(
        f"""transform(array_distinct(transform(filter(z.cells, c -> c.n = {n} AND c.c = xxhash64(c.k, 7)), c -> c.k)),
            k -> named_struct('n', {n}, 'k', k))"""
        for n in (1, -1)
    )
    step = let(
        "found",
        f"concat({pure})",
        "IF(size(found) = 0, named_struct('cells', z.cells, 'found', z.found, 'over', true), "
        f"named_struct('cells', {subtract('z.cells', _cells('found', s))}, "
        "'found', concat(z.found, found), 'over', false))",
    )
    start = f"""named_struct('cells', {cells},
        'found', cast(array() AS array<struct<n: int, k: bigint>>), 'over', false)"""
    empty = "forall(z.cells, c -> c.n = 0 AND c.k = 0L AND c.c = 0L)"
    return f"""aggregate(sequence(1, {rounds}), {start}, (z, i) -> IF(z.over, z, {step}),
        z -> IF({empty}, z.found, cast(NULL AS array<struct<n: int, k: bigint>>)))"""


def difference(a: str, b: str, params: SketchParams) -> str:
    """The digests in which two sets differ, by sketches grown until they peel.

    The first size holds at least the difference of the numbers of digests, which both sides know.
    """
    s = f"cast({params.cells} * shiftleft(1L, t + w) AS int)"
    tried = let(
        "s", s, peel(subtract(sketch(a, "s"), sketch(b, "s")), "s", params.rounds)
    )
    skip = f"cast(ceil(log2(greatest(1, abs(size({a}) - size({b})) / {2 * params.cells}))) AS int)"
    loop = f"""aggregate(sequence(0, {params.tries}), cast(NULL AS array<struct<n: int, k: bigint>>),
        (r, t) -> IF(r IS NOT NULL, r, {tried}))"""
    return let("w", skip, loop)


def likeness(a: str, b: str, params: SketchParams) -> Column:
    """Shared digests over all digests of two sets; 1 for two empty ones."""
    differ = f"size({difference(a, b, params)})"
    both = f"size({a}) + size({b})"
    body = f"IF({both} = 0, 1.0D, ({both} - d) / cast({both} + d AS double))"
    return F.expr(let("d", differ, body))


def fingerprint_text(keys: str, params: SketchParams) -> Column:
    """The first sketch as text: count, keys and checks of every cell."""
    cell = "concat(lpad(hex(c.n), 8, '0'), lpad(hex(c.k), 16, '0'), lpad(hex(c.c), 16, '0'))"
    return F.expr(
        f"base64(unhex(concat_ws('', transform({sketch(keys, str(params.cells))}, c -> {cell}))))"
    )


def fingerprints(docs: DataFrame, params: SketchParams = SketchParams()) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, next_id).

    The edited text is the text with its last floor(n_chars / 2) characters replaced by the first as
    many (or all) of the next document, by ascending doc_id; after the last comes the first. Rows
    of one doc_id follow each other by a hash of the text, null ids come first. Null text is
    empty. Other columns are not looked at.

    The order is found on ids and lengths alone. Texts are dealt by id once: both sides of the last join
    ask for the same columns of docs (the id as next_id), so that they read one exchange. Of each
    text only what the document before it takes over, and its digests, move a second time.
    """
    rows = docs.select(
        F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        fingerprint().alias("fp"),
    )
    keys = rows.select("id", "fp", F.length("text").alias("n")).groupBy("id", "fp").agg(
        F.max("n").alias("n"), F.count(F.lit(1)).alias("times")
    )
    order = dense_index(keys, ["id", "fp"], "place")
    last = (order.agg(F.max("place")).first()[0] or 0) + 1
    before = order.select(
        F.pmod(F.col("place") + 1, F.lit(last)).alias("place"),
        F.floor(F.col("n") / 2).cast("int").alias("wanted"),
        F.col("id").alias("for_id"), F.col("fp").alias("for_fp"),
    )
    known = order.join(before, "place").select("id", "fp", "times", "wanted", "for_id", "for_fp")
    # Rows that repeat a document follow each other; one text stands for them all.
    one = Window.partitionBy("id", "fp").orderBy("id", "fp")
    texts = rows.withColumn("_n", F.row_number().over(one)).where("_n = 1").drop("_n")
    texts = texts.join(known, ["id", "fp"]).withColumn("keys", F.expr(digests("text")))
    given = texts.select(
        "for_id", "for_fp", F.expr("left(text, wanted)").alias("given"),
        F.col("keys").alias("next_keys"), F.lit(1).cast("long").alias("copies"),
        F.col("doc_id").alias("next_id"),
    )
    itself = texts.where("times > 1").select(
        F.col("id").alias("for_id"), F.col("fp").alias("for_fp"),
        F.expr("left(text, cast(floor(length(text) / 2) AS int))").alias("given"),
        F.col("keys").alias("next_keys"), (F.col("times") - 1).alias("copies"),
        F.col("doc_id").alias("next_id"),
    )
    joined = texts.select("id", "fp", "doc_id", "text", "keys").join(
        given.union(itself), (F.col("id") == F.col("for_id")) & (F.col("fp") == F.col("for_fp"))
    )
    edited = (
        joined.withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("edited", F.expr("concat(left(text, cast(n_chars - floor(n_chars / 2) AS int)), given)"))
        .withColumn("edited_keys", F.expr(digests("edited")))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    )
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text("keys", params).alias("fingerprint"),
        fingerprint_text("edited_keys", params).alias("edited_fingerprint"),
        likeness("keys", "edited_keys", params).alias("near_edited"),
        likeness("keys", "next_keys", params).alias("near_next"),
        "next_id",
    )
