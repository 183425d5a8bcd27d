"""Language of a text by rank-order profiles.

A profile is the list of the most frequent character n-grams (one to three letters, words padded
with one blank) in order of frequency. The distance of a text to a language is the sum, over the
n-grams of the text's own profile, of how far each is out of place in the language's profile;
n-grams the language's profile lacks count as farthest. The nearest language wins.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partload.llm.common import slices, text_bytes
from partload.sources import storage

UNKNOWN = "und"
_BITS = 21  # of one code point
_letters: list[np.ndarray] = []


@dataclass(frozen=True)
class ProfileParams:
    """`size`: n-grams of a profile. `max_languages` bounds what is sent to the tasks
    (12 bytes for each n-gram); more languages than that are refused."""

    size: int = 300
    max_languages: int = 5_000


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or a blank if it is none."""
    if not _letters:
        table = np.full(0x110000, 32, dtype=np.int64)
        for i in range(0x110000):
            c = chr(i)
            if unicodedata.category(c)[0] == "L":
                low = c.lower()
                table[i] = ord(low) if len(low) == 1 else i
        _letters.append(table)
    return _letters[0]


def _letters_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters and blanks of all texts, each text behind one blank, and the n + 1 offsets."""
    data, offsets = text_bytes(column)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    letters = letter_table()[points]
    out = np.insert(letters, heads[:-1], 32)
    heads = heads + np.arange(len(offsets))
    # Runs of blanks are one.
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != 32) | (out[:-1] != 32)
    keep[heads[:-1]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[heads]


def _grams(letters: np.ndarray) -> np.ndarray:
    """All n-grams of one text (behind a blank), as numbers; those of blanks only are left out."""
    padded = np.append(letters, 32) if letters[-1] != 32 else letters
    two = padded[:-1] << _BITS | padded[1:]
    three = padded[:-2] << 2 * _BITS | two[1:]
    middle = padded[1:-1] != 32
    return np.concatenate([padded[padded != 32], two, three[middle]])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts by language, summed over the task."""
    parts: dict[str, list] = {}
    sizes: dict[str, int] = {}

    def merged(name: str) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in parts[name]])
        counts = np.concatenate([n for _, n in parts[name]])
        keys, which = np.unique(keys, return_inverse=True)
        return keys, np.bincount(which, counts, len(keys)).astype(np.int64)

    def row(name: str) -> pa.RecordBatch:
        keys, counts = merged(name)
        return pa.record_batch(
            {"lang": pa.array([name] * len(keys), pa.string()), "gram": pa.array(keys), "n": pa.array(counts)}
        )

    for batch in batches:
        for part in slices(batch, "text"):
            letters, heads = _letters_of(part.column("text"))
            names = part.column("lang").to_pylist()
            for name in set(names):
                rows = [i for i, x in enumerate(names) if x == name]
                own = [letters[heads[i] : heads[i + 1]] for i in rows]
                # Two blanks between texts, so that no n-gram joins them.
                grams = _grams(np.concatenate([np.append(x, 32) for x in own]))
                keys, counts = np.unique(grams[grams != 32 << _BITS | 32], return_counts=True)
                parts.setdefault(name, []).append((keys, counts))
                sizes[name] = sizes.get(name, 0) + len(keys)
                if sizes[name] > 1_000_000:
                    parts[name] = [merged(name)]
                    sizes[name] = len(parts[name][0][0])
            while sum(sizes.values()) > 4_000_000:
                largest = max(sizes, key=sizes.get)
                yield row(largest)
                del parts[largest], sizes[largest]
    for name in parts:
        yield row(name)


def train(texts: DataFrame, params: ProfileParams = ProfileParams()) -> DataFrame:
    """(lang, gram, place): the profile of each language of texts (text, lang); null lang is left out.

    Equally frequent n-grams go by their code points.
    """
    known = texts.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counts = known.mapInArrow(_counted, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return storage.materialise(
        counts.withColumn("place", place).where(F.col("place") <= params.size), "profiles"
    ).select("lang", "gram", (F.col("place") - 1).alias("place"))


class Profiles:
    """All profiles as one table: the place of every n-gram in each language, `size` if absent."""

    def __init__(self, rows: pa.Table, size: int):
        self.size = size
        self.languages = sorted(set(rows.column("lang").to_pylist()))
        number = {name: i for i, name in enumerate(self.languages)}
        self.grams = np.unique(rows.column("gram").to_numpy())
        self.places = np.full((len(self.languages), len(self.grams) + 1), size, dtype=np.int32)
        lang = np.array([number[x] for x in rows.column("lang").to_pylist()], dtype=np.int64)
        at = np.searchsorted(self.grams, rows.column("gram").to_numpy())
        self.places[lang, at] = rows.column("place").to_numpy()

    def nearest(self, letters: np.ndarray) -> tuple[str, float]:
        """The nearest language and 1 - distance / greatest distance; ties by code points."""
        if not self.languages or not (letters != 32).any():
            return UNKNOWN, 0.0
        keys, counts = np.unique(_grams(letters), return_counts=True)
        if len(keys) > self.size:
            least = np.partition(counts, len(counts) - self.size)[len(counts) - self.size]
            kept = counts >= least
            keys, counts = keys[kept], counts[kept]
        own = keys[np.argsort(-counts, kind="stable")][: self.size]
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        at[self.grams[at] != own] = len(self.grams)
        places = self.places[:, at]
        far = np.abs(places - np.arange(len(own), dtype=np.int32))
        far[places == self.size] = self.size
        distance = far.sum(axis=1)
        best = int(np.argmin(distance))
        return self.languages[best], 1.0 - float(distance[best]) / (self.size * len(own))


def _predicted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                letters, heads = _letters_of(part.column("text"))
                out = [profiles.nearest(letters[a:b]) for a, b in zip(heads[:-1], heads[1:], strict=True)]
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "lang_pred": pa.array([x for x, _ in out], pa.string()),
                        "score": pa.array([x for _, x in out], pa.float64()),
                    }
                )

    return run


def predict(docs: DataFrame, profiles: DataFrame, params: ProfileParams = ProfileParams()) -> DataFrame:
    """(doc_id, lang_pred, score), one row for each row of docs, from the text alone.

    Null texts, texts without a letter, and all texts when nothing was learned are `und` with score 0.
    """
    languages = profiles.select("lang").distinct().count()
    if languages > params.max_languages:
        raise ValueError(f"more than {params.max_languages} languages")
    shared = docs.sparkSession.sparkContext.broadcast(Profiles(profiles.toArrow(), params.size))
    return docs.select("doc_id", "text").mapInArrow(
        _predicted(shared), "doc_id long, lang_pred string, score double"
    )


def held_out() -> Column:
    """A fixed quarter of the documents, by a checksum of their id; a null id is not in it."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, params: ProfileParams = ProfileParams()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned on the rows not held out, predicted for all.

    Rows that repeat an id are predicted each. Other columns of docs are not looked at.
    """
    profiles = train(docs.where(~held_out()).select("text", "lang"), params)
    return predict(docs, profiles, params).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
