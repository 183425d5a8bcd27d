"""Vector best-fit packing of tokenised documents into sequences.

A sequence is a bin with three capacities: tokens, documents, and attention cost (the sum of squared
piece lengths, what a block-diagonal attention mask costs). A piece demands its length, 1 and its
length squared. Pieces are taken longest first; of the bins that can take a piece under every
constraint the one is chosen whose residual capacities, in parts of a full bin and weighted, have
the smallest norm afterwards (`rule="norm"`) or the largest dot product with the demand (`"dot"`).

Pieces are dealt at random to groups of bounded size, each packed in one task. A random group has
the length distribution of the whole, and only its last few bins stay open, so the number of
sequences is within about one for a group of what one global packing would need.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partload.llm.common import HashIndex, byte_values, running_hash, slices, span_hash, spread, text_bytes
from partload.sources import storage


@dataclass(frozen=True)
class PackParams:
    """Capacities of a sequence. The defaults of documents and attention never bind beside tokens.

    `per_group`: pieces packed in one task.
    """

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1)
    rule: str = "norm"
    end_id: int = 0
    per_group: int = 8192


_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[33:48] = _PUNCTUATION[58:65] = _PUNCTUATION[91:97] = _PUNCTUATION[123:127] = True


class CachedTokenizer:
    """Token ids of many texts, encoding every distinct stretch between safe cuts once.

    The byte-level pattern never joins the end of a word with what follows it, so a text may be cut in
    front of a space or line feed that follows an ASCII character other than white space or one of
    the Latin-1 block, and in front of ASCII punctuation that follows a letter. The tokenizer takes its added
    tokens (`<|endoftext|>`) out of a text first, so each is a stretch of its own. Stretches already met are
    looked up by hash; the store takes about `limit` of them and others are encoded again.
    """

    def __init__(self, path: str, limit: int = 1_500_000):
        # Tasks are parallel already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(x.lstrip or x.rstrip or x.single_word for x in added.values()):
            raise ValueError("added tokens that depend on their neighbours are not supported")
        names = sorted((x.content.encode() for x in added.values()), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, names))) if names else None
        # Joined stretches could spell such a name.
        self.alone = any(set(x) & set(b" \n") for x in names)
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        # One character of a byte-level token stands for one byte.
        self.width[list(vocabulary.values())] = [len(token) for token in vocabulary]
        for i, x in added.items():
            self.width[i] = len(x.content.encode())
        self.limit = limit
        self.known = HashIndex()
        self.count = np.zeros(0, np.int32)
        self.begin = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint16 if len(self.width) <= 1 << 16 else np.uint32)

    def _encode(self, parts: list[bytes], safe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token counts and ids of stretches; neighbours that are safe to join share a call."""
        texts, lengths, sizes = [], [], np.array([len(p) for p in parts])
        begin, size = 0, 0
        for i in range(len(parts)):
            if i > begin and (not safe[i] or not safe[i - 1] or size > 16_384):
                texts.append(b"".join(parts[begin:i]).decode())
                begin, size = i, 0
            size += len(parts[i])
        texts.append(b"".join(parts[begin:]).decode())
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, dtype=np.uint32) for x in found])
        lengths = np.cumsum(self.width[ids])
        ends = np.searchsorted(lengths, np.cumsum(sizes), side="left") + 1
        return np.diff(ends, prepend=0), ids

    def _added(self, raw: bytes, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        """Spans of added tokens within the texts: leftmost first, the longest of those."""
        found = self.added.search(raw) if self.added else None
        while found:
            start, end = found.span()
            inside = offsets[np.searchsorted(offsets, start, side="right")] >= end
            if inside:
                yield start, end
            found = self.added.search(raw, end if inside else start + 1)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and the n + 1 offsets of the texts in them."""
        n = len(data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        blank = (data == 32) | (data == 10)
        firm = (data > 32) & (data < 127)
        firm[1:] |= (data[1:] >= 128) & (data[:-1] == 0xC3)
        letter = _LETTER[data]
        cut = np.zeros(n + 1, dtype=bool)
        cut[1:n] = (blank[1:] & firm[:-1]) | (_PUNCTUATION[data[1:]] & letter[:-1])
        raw = data.tobytes()
        for a, b in self._added(raw, offsets):
            cut[a:b] = False
            cut[[a, b]] = True
        cut[offsets] = True
        bounds = np.flatnonzero(cut)
        start, end = bounds[:-1], bounds[1:]
        hashes = span_hash(running_hash(byte_values(data)), start, end)
        which = self.known.get(hashes)
        count, begin, store = self.count, self.begin, self.ids
        miss = np.flatnonzero(which < 0)
        if len(miss):
            new, sample, inverse = np.unique(hashes[miss], return_index=True, return_inverse=True)
            s, e = start[miss[sample]], end[miss[sample]]
            safe = blank[s] & firm[e - 1] & (not self.alone)
            # Unsafe ones last: each is encoded alone.
            order = np.argsort(~safe, kind="stable")
            parts = [raw[a:b] for a, b in zip(s[order].tolist(), e[order].tolist(), strict=True)]
            got, ids = self._encode(parts, safe[order])
            place = np.empty(len(new), dtype=np.int32)
            place[order] = np.arange(len(count), len(count) + len(new))
            which[miss] = place[inverse]
            begin = np.concatenate([begin, (len(store) + np.cumsum(got) - got).astype(np.int32)])
            count = np.concatenate([count, got.astype(np.int32)])
            store = np.concatenate([store, ids.astype(store.dtype)])
            if len(count) <= self.limit:
                self.known.add(new, place)
                self.count, self.begin, self.ids = count, begin, store
        tokens = count[which]
        ends = np.cumsum(tokens)
        source = np.repeat(begin[which] - (ends - tokens).astype(np.int32), tokens)
        source += np.arange(len(source), dtype=np.int32)
        text_ends = np.concatenate([[0], ends])[np.searchsorted(start, offsets)]
        return store[source], text_ends


_loaded: dict[str, CachedTokenizer] = {}


def tokenizer(path: str) -> CachedTokenizer:
    """One for each worker process."""
    if path not in _loaded:
        _loaded[path] = CachedTokenizer(path)
    return _loaded[path]


def _pieces(path: str, params: PackParams):
    size = params.tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path)
        for batch in batches:
            for part in slices(batch, "text", 1 << 21):
                ids, ends = encode(*text_bytes(part.column("text")))
                ids = ids.astype("<u4")
                row, piece, start, length, crc = [], [], [], [], []
                tail = np.array([params.end_id], dtype="<u4").tobytes()
                for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                    raw = ids[a:b].tobytes() + tail
                    n = b - a + 1
                    at, to = 0, n % size or size
                    while at < n:
                        row.append(i)
                        piece.append(piece[-1] + 1 if at else 0)
                        start.append(at)
                        length.append(to - at)
                        crc.append(zlib.crc32(raw[4 * at : 4 * to]))
                        at, to = to, to + size
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id").take(pa.array(row, pa.int64())),
                        "piece": pa.array(piece, pa.int32()),
                        "start": pa.array(start, pa.int64()),
                        "length": pa.array(length, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    return run


def token_pieces(docs: DataFrame, path: str, params: PackParams) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the pieces of every document.

    A document is its ids and the end id. Only longer ones are cut, into full pieces; the first
    piece is the shorter one.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _pieces(path, params), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def best_fit(lengths: np.ndarray, params: PackParams) -> np.ndarray:
    """The bin of each piece."""
    lengths = np.asarray(lengths, dtype=np.int64)
    capacity = np.array([params.tokens, params.documents, params.attention], dtype=np.int64)
    weights = np.array(params.weights)
    demand = np.stack([lengths, np.ones_like(lengths), lengths * lengths], axis=1)
    if (demand > capacity).any():
        raise ValueError("a piece is larger than a sequence")
    out = np.zeros(len(lengths), dtype=np.int64)
    full = lengths == params.tokens
    out[full] = np.arange(full.sum())
    order = np.flatnonzero(~full)
    order = order[np.argsort(-lengths[order], kind="stable")]
    least = demand[order].min(axis=0) if len(order) else capacity
    # One row for each capacity, one column for each bin that can still take the shortest piece.
    room = np.zeros((3, max(len(order), 1)), dtype=np.int64)
    name = np.zeros(max(len(order), 1), dtype=np.int64)
    used = [(k, w) for k, w in enumerate(weights) if w]
    bins, opened = 0, int(full.sum())
    for turn, i in enumerate(order):
        need = demand[i]
        if turn % 64 == 63:
            live = np.flatnonzero((room[:, :bins] >= least[:, None]).all(axis=0))
            room[:, : len(live)], name[: len(live)] = room[:, live], name[live]
            bins = len(live)
        fits = np.flatnonzero(
            (room[0, :bins] >= need[0]) & (room[1, :bins] >= need[1]) & (room[2, :bins] >= need[2])
        )
        if len(fits):
            score = 0.0
            for k, w in used:
                if params.rule == "dot":
                    score = score - w * (need[k] / capacity[k]) * (room[k, fits] / capacity[k])
                else:
                    score = score + w * np.square((room[k, fits] - need[k]) / capacity[k])
            best = fits[np.argmin(score)]
        else:
            best = bins
            room[:, best], name[best] = capacity, opened
            bins += 1
            opened += 1
        room[:, best] -= need
        out[i] = name[best]
    return out


def _packed(params: PackParams):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        bins = best_fit(lengths, params)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[order])
        first = np.ones(len(order), dtype=bool)
        first[1:] = bins[order][1:] != bins[order][:-1]
        base = np.repeat((ends - lengths[order])[first], np.diff(np.append(np.flatnonzero(first), len(order))))
        offset = np.zeros(len(order), dtype=np.int64)
        offset[order] = ends - lengths[order] - base
        group = key[0].as_py()
        table = table.drop_columns(["group"])
        table = table.append_column("sequence_id", pa.array(bins + (group << 32), pa.int64()))
        return table.append_column("offset", pa.array(offset, pa.int64()))

    return run


def pack(docs: DataFrame, path: str, params: PackParams = PackParams()) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row for each piece.

    `path` names the tokenizer file. Null and empty texts are one piece of the end id alone. Rows
    that repeat a document are packed each. Other columns of docs are not looked at.
    """
    pieces = storage.materialise(token_pieces(docs, path, params), "pieces")
    groups = spread(pieces.count(), params.per_group)
    dealt = pieces.withColumn(
        "group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    )
    return dealt.groupBy("group").applyInArrow(
        _packed(params),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
