"""Ranked lexical search over K2-treaps of term-document grids.

Documents are indexed where they lie, in shards. A shard's grid has a row for each of its terms, the
commonest first, a column for each document in the order of doc_id, and in every occupied cell the
impact of the term in the document. The grid is cut into quadrants again and again; each quadrant
keeps its largest impact with its place, and takes that cell out before it is cut. What is stored is, level by
level, which quadrants are occupied, the place of the maximum within the quadrant, and by how much it
falls short of the maximum above. Rows are stretched, so that a quadrant is down to one term while it
still spans several documents.

An item's terms descend together: a range of documents carries the quadrants its rows still have
there and the cells of its rows that were taken out above, which bound the score of every document in the range.
The ranges of the highest bounds are cut first, until none left can reach the best scores found.
Weights of terms come from the whole index and enter at search time only.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partload.llm.common import byte_values, running_hash, span_hash, text_bytes
from partload.sources import storage

_U = np.uint64
_BYTES = np.arange(256)
# Fixed by the contract: a term is a run of ASCII letters and digits and of all that is not ASCII.
_TERM = (
    (_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES <= 57))
    | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122))
)
_ONES = np.array([bin(i).count("1") for i in range(16)], dtype=np.int64)


@dataclass(frozen=True)
class SearchParams:
    """`top`: documents for each item. `cells`: of a shard, which a longer single text exceeds;
    `stretch`: documents (as a power of two) a quadrant of one row still spans. `block_terms`: terms of
    the items sent to the tasks at a time; `step_terms`: of those that descend together; `step`:
    ranges an item cuts at a time."""

    top: int = 10
    cells: int = 1 << 20
    stretch: int = 5
    block_terms: int = 1 << 17
    step_terms: int = 2048
    step: int = 24


# Terms ---------------------------------------------------------------------------------------


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of every term of a column of texts, in order.

    Long columns are worked off in stretches that end between terms.
    """
    texts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, _U)]
    at = 0
    while at < len(data):
        to = min(at + (1 << 20), len(data))
        while to < len(data) and _TERM[data[to]]:
            to += 1
        part = data[at:to]
        term = _TERM[part]
        edge = np.zeros(len(part) + 1, dtype=bool)
        inside = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to, side="right")]
        edge[inside - at] = True
        start = np.flatnonzero(term & (~np.concatenate([[False], term[:-1]]) | edge[:-1]))
        end = np.flatnonzero(term & (~np.concatenate([term[1:], [False]]) | edge[1:])) + 1
        texts.append(np.searchsorted(offsets, start + at, side="right") - 1)
        hashes.append(span_hash(running_hash(byte_values(part, lower=True)), start, end))
        at = to
    return np.concatenate(texts), np.concatenate(hashes)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    documents = terms = 0
    for batch in batches:
        text, _ = term_hashes(*text_bytes(batch.column("text")))
        documents, terms = documents + len(np.unique(text)), terms + len(text)
    yield pa.record_batch({"documents": pa.array([documents], pa.int64()), "terms": pa.array([terms], pa.int64())})


# Building ------------------------------------------------------------------------------------


def _spread(x: np.ndarray) -> np.ndarray:
    """The lower 32 bits of each number at the even places of 64."""
    x = x.astype(_U)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333), (1, 0x5555555555555555),
    ):
        x = (x | (x << _U(shift))) & _U(mask)
    return x


def _narrow(x: np.ndarray) -> np.ndarray:
    top = int(x.max(initial=0))
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def build_levels(row: np.ndarray, col: np.ndarray, value: np.ndarray, height: int, up: int) -> list[bytes]:
    """The levels of the treap of distinct cells; rows are multiplied by 2**up first."""
    code = (_spread(row << up) << _U(1)) | _spread(col)
    order = np.argsort(code)
    code, row, col, value = code[order], row[order], col[order], value[order]
    out: list[bytes] = []
    above = np.zeros(1, dtype=_U)
    above_value = np.array([value.max(initial=0)])
    held = None
    for level in range(height + 1):
        prefix = code >> _U(2 * (height - level))
        first = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]])) if len(prefix) else np.zeros(0, int)
        if held is not None:
            # Which quadrants of the level above are occupied is known only now.
            bits = np.zeros(len(above), dtype=np.uint8)
            parent = np.searchsorted(above, prefix[first] >> _U(2))
            np.bitwise_or.at(bits, parent, (1 << (prefix[first] & _U(3)).astype(np.int64)).astype(np.uint8))
            out.append(_packed_level(bits, *held))
        if not len(first):
            return out
        size = np.diff(np.append(first, len(prefix)))
        most = np.maximum.reduceat(value, first)
        at = np.flatnonzero(value == np.repeat(most, size))
        group = np.searchsorted(first, at, side="right") - 1
        at = at[np.concatenate([[True], group[1:] != group[:-1]])]
        parent = np.searchsorted(above, prefix[first] >> _U(2)) if level else np.zeros(1, int)
        local_row = row[at] & ((1 << max(height - level - up, 0)) - 1)
        local_col = col[at] & ((1 << (height - level)) - 1)
        held = (above_value[parent] - most, local_row, local_col)
        above, above_value = prefix[first], most
        stay = np.ones(len(code), dtype=bool)
        stay[at] = False
        code, row, col, value = code[stay], row[stay], col[stay], value[stay]
    out.append(_packed_level(np.zeros(len(above), np.uint8), *held))
    return out


def _packed_level(bits: np.ndarray, *numbers: np.ndarray) -> bytes:
    narrow = [_narrow(x) for x in numbers]
    half = np.append(bits, np.zeros(len(bits) % 2, np.uint8)).reshape(-1, 2)
    head = struct.pack("<q3B", len(bits), *[x.itemsize for x in narrow])
    return head + (half[:, 0] | (half[:, 1] << 4)).astype(np.uint8).tobytes() + b"".join(x.tobytes() for x in narrow)


def _read_level(raw: bytes) -> tuple[np.ndarray, ...]:
    n, *sizes = struct.unpack_from("<q3B", raw)
    at = 11
    half = np.frombuffer(raw, np.uint8, (n + 1) // 2, at)
    at += len(half)
    out = [np.stack([half & 15, half >> 4], axis=1).reshape(-1)[:n]]
    for size in sizes:
        out.append(np.frombuffer(raw, f"<u{size}", n, at).astype(np.int64))
        at += size * n
    return tuple(out)


def _impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """(10**9 tf) div (1000 tf + 8 m), with m of the document's length n; exact at any size."""
    if 90 * int(n.max(initial=0)) * documents >= 1 << 63:
        n = n.astype(object)
    m = (100 - 90 + (90 * n * documents) // max(terms, 1)).astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


_INDEX = (
    "doc_ids binary, no_id binary, terms binary, counts binary, height int, up int, largest long, "
    "levels array<binary>"
)


def _indexed(params: SearchParams, documents: int, terms: int):
    def shard(ids: np.ndarray, null: np.ndarray, doc: np.ndarray, term: np.ndarray, value: np.ndarray) -> dict:
        column = np.lexsort((ids, null))
        place = np.empty(len(ids), dtype=np.int64)
        place[column] = np.arange(len(ids))
        names, number, count = np.unique(term, return_inverse=True, return_counts=True)
        common = np.argsort(-count, kind="stable")
        row = np.empty(len(names), dtype=np.int64)
        row[common] = np.arange(len(names))
        rows, cols = (max(int(x) - 1, 0).bit_length() for x in (len(names), len(ids)))
        height = max(rows + min(params.stretch, cols), cols)
        levels = build_levels(row[number], place[doc], value, height, height - rows)
        return {
            "doc_ids": ids[column].tobytes(), "no_id": np.packbits(null[column]).tobytes(),
            "terms": names[common].tobytes(), "counts": count[common].astype(np.uint32).tobytes(),
            "height": height, "up": height - rows, "largest": int(value.max()), "levels": levels,
        }

    types = pa.schema([
        ("doc_ids", pa.binary()), ("no_id", pa.binary()), ("terms", pa.binary()), ("counts", pa.binary()),
        ("height", pa.int32()), ("up", pa.int32()), ("largest", pa.int64()), ("levels", pa.list_(pa.binary())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        cells = texts = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, cells, texts
            parts = [np.concatenate(x) for x in zip(*held, strict=True)]
            held, cells, texts = [], 0, 0
            return pa.RecordBatch.from_pylist([shard(*parts)], schema=types)

        for batch in batches:
            text, term = term_hashes(*text_bytes(batch.column("text")))
            length = np.bincount(text, minlength=batch.num_rows)
            order = np.lexsort((term, text))
            text, term = text[order], term[order]
            new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (term[1:] != term[:-1])])) if len(text) else np.zeros(0, int)
            tf = np.diff(np.append(new, len(text)))
            text, term = text[new], term[new]
            value = _impacts(tf, length[text], documents, terms)
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            null = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            # Texts without terms can have no score.
            used, text = np.unique(text, return_inverse=True)
            ahead = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(used)))]) if len(used) else np.zeros(1, int)
            at = 0
            while at < len(used):
                room = max(params.cells - cells, 0)
                to = max(int(np.searchsorted(ahead, ahead[at] + room, side="right")) - 1, at + (not held))
                if to > at:
                    part = slice(ahead[at], ahead[to])
                    held.append((ids[used[at:to]], null[used[at:to]], text[part] - at + texts, term[part], value[part]))
                    cells, texts = cells + int(ahead[to] - ahead[at]), texts + to - at
                    at = to
                if at < len(used):
                    yield flush()
        if held:
            yield flush()

    return run


def build_index(docs: DataFrame, params: SearchParams = SearchParams()) -> tuple[DataFrame, int]:
    """A stored index of all docs (doc_id, text), one row for each shard, and how many have terms.

    Nothing is shuffled: shards are made where the texts are read. A first pass counts documents and
    terms, which every impact depends on. Null texts and texts without terms have no cells.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    counted = rows.select("text").mapInArrow(_counted, "documents long, terms long")
    n, terms = counted.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    return storage.materialise(rows.mapInArrow(_indexed(params, n, terms), _INDEX), "index"), n


# Searching -----------------------------------------------------------------------------------


def _slices(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start[i] .. start[i] + size[i] - 1 of all i in turn."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


class _Pool:
    """Columns that grow."""

    def __init__(self, *names: str):
        self.size, self.columns = 0, {n: np.zeros(1024, dtype=np.int64) for n in names}

    def add(self, **arrays: np.ndarray) -> int:
        first, n = self.size, len(next(iter(arrays.values())))
        for name, x in arrays.items():
            column = self.columns[name]
            if first + n > len(column):
                column = np.concatenate([column, np.zeros(max(len(column), n), dtype=np.int64)])
                self.columns[name] = column
            column[first : first + n] = x
        self.size += n
        return first

    def __getitem__(self, name: str) -> np.ndarray:
        return self.columns[name]


class Grid:
    """A shard's treap as arrays over its nodes, level by level."""

    def __init__(self, shard: dict):
        self.height, self.up = shard["height"], shard["up"]
        self.doc_ids = np.frombuffer(shard["doc_ids"], np.int64)
        self.no_id = np.unpackbits(np.frombuffer(shard["no_id"], np.uint8))[: len(self.doc_ids)].astype(bool)
        terms = np.frombuffer(shard["terms"], _U)
        self.by_hash = np.argsort(terms)
        self.terms = terms[self.by_hash]
        levels = [_read_level(x) for x in shard["levels"]]
        self.bits = np.concatenate([x[0] for x in levels])
        below = _ONES[self.bits]
        self.base = 1 + np.cumsum(below) - below
        parent = np.repeat(np.arange(len(self.bits)), below)
        value, rows, cols = [], [], []
        at_row, at_col = np.zeros(1, np.int64), np.zeros(1, np.int64)
        done = 0
        for i, (bits, less, row, col) in enumerate(levels):
            n, left = len(bits), self.height - i
            if i:
                up = parent[done - 1 : done - 1 + n] - (done - len(levels[i - 1][0]))
                kind = np.flatnonzero((levels[i - 1][0][:, None] >> np.arange(4)) & 1) % 4
                at_row, at_col = 2 * at_row[up] + kind // 2, 2 * at_col[up] + kind % 2
                value.append(value[-1][up] - less)
            else:
                value.append(np.zeros(1, np.int64))
            rows.append(((at_row << left) >> self.up) + row)
            cols.append((at_col << left) + col)
            done += n
        self.value, self.row, self.col = (np.concatenate(x) for x in (value, rows, cols))
        # Stored values fall short of the largest; the largest itself comes with the root.
        self.value += shard["largest"]
        self.rest = np.zeros(len(self.bits), dtype=np.int64)
        np.maximum.at(self.rest, parent, self.value[1:])

    def rows_of(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each term, -1 where the shard does not have it."""
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, self.by_hash[at], -1)

    def best(
        self, item: np.ndarray, row: np.ndarray, weight: np.ndarray, floor: np.ndarray, params: SearchParams
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, score, column) of the best documents of each item, with scores of `floor` or more.

        Terms come as parallel arrays; items are numbers into `floor`.
        """
        ranges = _Pool("item", "level", "start", "bound", "nodes", "n_nodes", "points", "n_points")
        nodes, points = _Pool("term", "node"), _Pool("term", "col", "value")
        stretched = row << self.up
        found = [np.zeros(0, np.int64)] * 3
        floor = np.maximum(floor, 1)
        top, n_terms = params.top, len(row)

        def settle(items, scores, cols):
            """Take in exact scores and raise the floors."""
            nonlocal found
            keep = scores >= floor[items]
            found = [np.concatenate([a, b[keep]]) for a, b in zip(found, (items, scores, cols), strict=True)]
            order = np.lexsort((found[2], -found[1], found[0]))
            found = [x[order] for x in found]
            place = np.arange(len(order)) - np.searchsorted(found[0], found[0])
            full = place == top - 1
            floor[found[0][full]] = np.maximum(floor[found[0][full]], found[1][full])
            keep = place < top
            found = [x[keep] for x in found]

        def take(owner, items, level, start, n_term, n_node, p_owner, p_term, p_col, p_value):
            """New ranges `owner` with nodes and points; ranges without nodes are scored at once."""
            hit = self.row[n_node] == row[n_term]
            p_owner = np.concatenate([p_owner, owner[hit]])
            p_term = np.concatenate([p_term, n_term[hit]])
            p_col = np.concatenate([p_col, self.col[n_node[hit]]])
            p_value = np.concatenate([p_value, self.value[n_node[hit]]])
            live = self.bits[n_node] != 0
            owner, n_term, n_node = owner[live], n_term[live], n_node[live]
            # What each row can give at most in each range.
            pair = np.concatenate([owner, p_owner]) * n_terms + np.concatenate([n_term, p_term])
            most = np.concatenate([self.rest[n_node], p_value])
            order = np.lexsort((most, pair))
            pair, most = pair[order], most[order]
            last = np.flatnonzero(np.concatenate([pair[1:] != pair[:-1], [True]])) if len(pair) else np.zeros(0, int)
            pair, most = pair[last], most[last] * weight[pair[last] % n_terms]
            bound = np.zeros(len(items), dtype=np.int64)
            whose = pair // n_terms
            first = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1]])) if len(whose) else np.zeros(0, int)
            if len(first):
                bound[whose[first]] = np.add.reduceat(most, first)
            reach = bound >= floor[items]
            open_ = np.zeros(len(items), dtype=bool)
            open_[owner] = True
            # Ranges without nodes: their points are all there is.
            done = (reach & ~open_)[p_owner]
            if done.any():
                who, col, gain = p_owner[done], p_col[done], p_value[done] * weight[p_term[done]]
                order = np.lexsort((col, who))
                who, col, gain = who[order], col[order], gain[order]
                first = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (col[1:] != col[:-1])]))
                settle(items[who[first]], np.add.reduceat(gain, first), col[first])
            keep = reach & open_
            name = np.cumsum(keep) - 1
            mine, his = keep[owner], keep[p_owner]
            by, of = np.argsort(owner[mine], kind="stable"), np.argsort(p_owner[his], kind="stable")
            n_nodes = np.bincount(name[owner[mine]], minlength=int(keep.sum()))
            n_points = np.bincount(name[p_owner[his]], minlength=int(keep.sum()))
            n_at = nodes.add(term=n_term[mine][by], node=n_node[mine][by])
            p_at = points.add(term=p_term[his][of], col=p_col[his][of], value=p_value[his][of])
            ranges.add(
                item=items[keep], level=level[keep], start=start[keep], bound=bound[keep],
                nodes=n_at + np.cumsum(n_nodes) - n_nodes, n_nodes=n_nodes,
                points=p_at + np.cumsum(n_points) - n_points, n_points=n_points,
            )

        every = np.unique(item)
        zero = np.zeros(len(every), dtype=np.int64)
        none = np.zeros(0, dtype=np.int64)
        take(
            np.searchsorted(every, item), every, zero, zero, np.arange(n_terms), np.zeros(n_terms, np.int64),
            none, none, none, none,
        )
        waiting = np.arange(ranges.size)
        while len(waiting):
            items, bound = ranges["item"][waiting], ranges["bound"][waiting]
            order = np.flatnonzero(bound >= floor[items])
            order = order[np.lexsort((ranges["start"][waiting[order]], -bound[order], items[order]))]
            waiting, items = waiting[order], items[order]
            now = np.arange(len(items)) - np.searchsorted(items, items) < params.step
            cut, waiting = waiting[now], waiting[~now]
            if not len(cut):
                break
            n = ranges["n_nodes"][cut]
            at, who = _slices(ranges["nodes"][cut], n), np.repeat(np.arange(len(cut)), n)
            term, node = nodes["term"][at], nodes["node"][at]
            left = self.height - ranges["level"][cut] - 1
            low = (stretched[term] >> left[who]) & 1
            owners, terms_, kids = [], [], []
            for side in (0, 1):
                kind = 2 * low + side
                has = (self.bits[node] >> kind) & 1 == 1
                ahead = _ONES[self.bits[node] & ((1 << kind) - 1)]
                owners.append((2 * who + side)[has])
                terms_.append(term[has])
                kids.append((self.base[node] + ahead)[has])
            n = ranges["n_points"][cut]
            at, who = _slices(ranges["points"][cut], n), np.repeat(np.arange(len(cut)), n)
            col = points["col"][at]
            p_owner = 2 * who + ((col >> left[who]) & 1)
            before = ranges.size
            both = np.repeat(np.arange(len(cut)), 2)
            take(
                np.concatenate(owners), ranges["item"][cut][both], ranges["level"][cut][both] + 1,
                2 * ranges["start"][cut][both] + np.tile([0, 1], len(cut)),
                np.concatenate(terms_), np.concatenate(kids),
                p_owner, points["term"][at], col, points["value"][at],
            )
            waiting = np.concatenate([waiting, np.arange(before, ranges.size)])
        return tuple(found)


def _frequencies(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        total = np.zeros(len(wanted), dtype=np.int64)
        for batch in batches:
            for terms, counts in zip(*(batch.column(c).to_pylist() for c in ("terms", "counts")), strict=True):
                terms, counts = np.frombuffer(terms, _U), np.frombuffer(counts, np.uint32)
                at = np.minimum(np.searchsorted(wanted, terms), len(wanted) - 1)
                same = wanted[at] == terms
                total[at[same]] += counts[same]
        some = np.flatnonzero(total)
        yield pa.record_batch({"term": pa.array(wanted[some].view(np.int64)), "df": pa.array(total[some])})

    return run


def _searched(shared, params: SearchParams):
    """The best documents of each item among the shards of a task, the floor rising from shard to shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, owner, weight = shared.value
        items = int(owner.max(initial=-1)) + 1
        best = [np.zeros(0, np.int64)] * 4
        floor = np.ones(items, dtype=np.int64)
        # Items that descend together.
        group = np.cumsum(np.bincount(owner, minlength=items)) // params.step_terms
        for batch in batches:
            for shard in batch.to_pylist():
                grid = Grid(shard)
                row = grid.rows_of(hashes)
                got = []
                for g in np.unique(group):
                    use = (group[owner] == g) & (row >= 0) & (weight > 0)
                    if use.any():
                        got.append(grid.best(owner[use], row[use], weight[use], floor, params))
                if not got:
                    continue
                item, score, col = (np.concatenate(x) for x in zip(*got, strict=True))
                new = (item, score, grid.no_id[col].astype(np.int64), grid.doc_ids[col])
                best = [np.concatenate(x) for x in zip(best, new, strict=True)]
                order = np.lexsort((best[3], best[2], -best[1], best[0]))
                best = [x[order] for x in best]
                place = np.arange(len(order)) - np.searchsorted(best[0], best[0])
                full = place == params.top - 1
                floor[best[0][full]] = best[1][full]
                best = [x[place < params.top] for x in best]
        yield pa.record_batch(
            {
                "item": pa.array(best[0]), "score": pa.array(best[1]),
                "doc_id": pa.array(best[3], mask=best[2].astype(bool)),
            }
        )

    return run


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, term = term_hashes(*text_bytes(batch.column("text")))
        at = np.searchsorted(text, np.arange(batch.num_rows + 1))
        sets = [np.unique(term[a:b]).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.record_batch(
            {"item": batch.column("item"), "item_id": batch.column("item_id"), "terms": pa.array(sets, pa.binary())}
        )


def _blocks(asked: DataFrame, limit: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Items with their terms, streamed in blocks of about `limit` terms."""
    block, size = [], 0
    for r in asked.where(F.length("terms") > 0).select("item", "terms").toLocalIterator():
        terms = np.frombuffer(bytes(r.terms), _U)
        if block and size + len(terms) > limit:
            yield block
            block, size = [], 0
        block.append((r.item, terms))
        size += len(terms)
    if block:
        yield block


def search(index: DataFrame, n: int, items: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents of an index for each row of items.

    Items (item_id, text) meet the index in blocks of bounded size; one block is at a time in the
    tasks, each of which returns at most `top` documents for an item. Items without terms, or whose
    terms no document has, have no rows. Rows that repeat an item_id are items of their own.
    """
    spark = index.sparkSession
    sc = spark.sparkContext
    asked = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), "text")
    asked = asked.mapInArrow(_asked, "item long, item_id long, terms binary")
    asked = storage.materialise(asked, "asked")
    out = None
    for block in _blocks(asked, params.block_terms):
        names = np.array([k for k, _ in block])
        owner = np.repeat(np.arange(len(block)), [len(t) for _, t in block])
        hashes = np.concatenate([t for _, t in block])
        wanted = sc.broadcast(np.unique(hashes))
        counted = index.select("terms", "counts").mapInArrow(_frequencies(wanted), "term long, df long")
        df = dict(counted.groupBy("term").agg(F.sum("df")).collect())
        wanted.destroy()
        held = np.array([df.get(int(h), 0) for h in hashes.view(np.int64)])
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) if d else 0 for d in held.tolist()])
        shared = sc.broadcast((hashes, owner, weight))
        found = index.mapInArrow(_searched(shared, params), "item long, score long, doc_id long")
        first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= params.top)
        name = F.element_at(F.lit(names.tolist()), (F.col("item") + 1).cast("int"))
        part = storage.materialise(found.withColumn("item", name), "found")
        shared.destroy()
        out = part if out is None else out.union(part)
    if out is None:
        out = asked.where("false").selectExpr("item", "0L AS score", "0L AS doc_id", "0 AS rank")
    return out.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """(item_id, rank, doc_id, score) of the best docs (doc_id, text) for each item (item_id, text).

    Equal scores come in ascending order of doc_id; a null doc_id comes last. Rows that share a doc_id
    are documents of their own. Other columns of either table are not looked at.
    """
    index, n = build_index(docs, params)
    return search(index, n, items, params)
