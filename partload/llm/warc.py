"""WARC archives with a dictionary: written record by record, read back the same way.

An archive is a file `.warc.zst`: a skippable frame that holds a Zstandard dictionary built from
records of this archive, then one frame for each record, compressed with that dictionary, so that any
record can be read on its own. A payload archived before is a revisit record that refers to it.

Tasks write archives of bounded size to the shared folder and return what they wrote. Only archives in
that list count: a task that is lost and repeated writes files of other names.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partload.llm.common import spread
from partload.sources import storage

# Fixed values of the WARC and Zstandard formats.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

READ_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, archive string, offset long"
)


@dataclass(frozen=True)
class WarcParams:
    """`archive_bytes` of records before compression in an archive; a dictionary of `dictionary_bytes`
    is trained on records of up to `sample_bytes`, spread over the archive. Payloads of at least
    `revisit_bytes` are revisited. `date` stands in every record."""

    archive_bytes: int = 16 << 20
    dictionary_bytes: int = 32 << 10
    sample_bytes: int = 2 << 20
    revisit_bytes: int = 0
    level: int = 3
    date: str = "2024-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*name: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, ' '.join(map(str, name)))}>"


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in fields]]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(
    page_id: int | None,
    url: str | None,
    html: str | None,
    refers_to: int | None,
    params: WarcParams,
    name: str | None = None,
    named: bool = True,
) -> bytes:
    """One record. Its id comes from page_id and payload, or from `name`, which a page that is repeated
    or has no id needs to be unique. A revisit names the id it refers to only if that page is `named` so."""
    payload = (html or "").encode()
    digest = digest_of(payload)
    target = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:page:{page_id}"
    fields = [
        ("WARC-Record-ID", record_id(name) if name else record_id(page_id, digest)),
        ("WARC-Date", params.date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if url is not None:
        fields.append(("X-Page-URL", quote(url, safe="")))
    head = _HTTP + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return record("response", fields, head + payload)
    fields += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page", str(refers_to))]
    if named:
        fields.append(("WARC-Refers-To", record_id(refers_to, digest)))
    return record("revisit", fields, head)


def build_dictionary(records: list[bytes], params: WarcParams) -> zstandard.ZstdCompressionDict:
    """A dictionary from records spread over the archive; of too few, their content is one."""
    total = sum(map(len, records))
    step = max(1, -(-total // params.sample_bytes))
    sample = [r for r in records[::step] if len(r) >= 8]
    name = 32_768 + zlib.crc32(b"".join(r[:64] for r in sample)) % (1 << 30)
    try:
        return zstandard.train_dictionary(
            params.dictionary_bytes, sample, k=200, d=8, dict_id=name, level=params.level
        )
    except zstandard.ZstdError:
        content = b"".join(sample)[: params.dictionary_bytes] or b"WARC"
        return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(records: list[bytes], out: io.RawIOBase, params: WarcParams, name: str = "archive") -> None:
    """The dictionary, a warcinfo record for the archive `name`, and the records."""
    dictionary = build_dictionary(records, params)
    frame = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
    out.write(struct.pack("<II", DICTIONARY_FRAME, len(frame)) + frame)
    dictionary.precompute_compress(level=params.level)
    compressor = zstandard.ZstdCompressor(
        level=params.level, dict_data=dictionary, write_content_size=True, write_checksum=True
    )
    about = [
        ("WARC-Record-ID", record_id("warcinfo", name)),
        ("WARC-Date", params.date),
        ("WARC-Filename", name.rsplit("/", 1)[-1]),
        ("Content-Type", "application/warc-fields"),
    ]
    info = record("warcinfo", about, b"format: WARC File Format 1.1\r\n")
    for r in [info, *records]:
        out.write(compressor.compress(r))


def read_archive(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of every record of an archive."""
    magic, size = struct.unpack("<II", data[:8])
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame at the start of the archive")
    raw = data[8 : 8 + size]
    if raw[:4] == ZSTD_MAGIC:
        raw = zstandard.ZstdDecompressor().decompress(raw)
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    at = 8 + size
    view = memoryview(data)
    while at < len(data):
        one = plain.decompressobj()
        out, used = [], at
        while not one.eof and used < len(data):
            out.append(one.decompress(view[used : used + 65_536]))
            used += 65_536
        if not one.eof:
            raise ValueError("the archive ends within a record")
        text = b"".join(out)
        head, _, rest = text.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"not a record: {lines[0][:40]}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        yield at, fields, rest[: int(fields["Content-Length"])]
        at = min(used, len(data)) - len(one.unused_data)


def _open(path: str):
    """The file system and the place of a path; s3a, as Spark calls it, is s3."""
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))


def _written(folder: str, params: WarcParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        stem = f"{folder}/{context.partitionId():06d}-{uuid.uuid4().hex}"
        records: list[bytes] = []
        size = made = 0

        def close() -> pa.RecordBatch:
            path = f"{stem}-{made:04d}.warc.zst"
            system, place = _open(path)
            with system.open_output_stream(place) as out:
                write_archive(records, out, params, path)
            return pa.record_batch({"archive": [path], "records": pa.array([len(records)], pa.int64())})

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "refers_to", "repeated", "named")]
            for values in zip(*columns, strict=True):
                *page, repeated, named = [v.as_py() for v in values]
                name = f"{stem} {made} {len(records)}" if repeated else None
                records.append(page_record(*page, params, name, named))
                size += len(records[-1])
                if size >= params.archive_bytes:
                    yield close()
                    records, size, made = [], 0, made + 1
        if records:
            yield close()

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("archive").to_pylist():
            system, place = _open(path)
            with system.open_input_stream(place) as source:
                data = source.read()
            rows: dict[str, list] = {k.split()[0]: [] for k in READ_SCHEMA.split(", ")}
            for at, fields, block in read_archive(data):
                kind = fields["WARC-Type"]
                if kind == "warcinfo":
                    continue
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and digest_of(block.partition(b"\r\n\r\n")[2]) != digest:
                    raise ValueError(f"payload of {fields['WARC-Record-ID']} in {path} is damaged")
                number = lambda name: int(fields[name]) if name in fields else None
                rows["page_id"].append(number("X-Page-ID"))
                rows["url"].append(fields.get("WARC-Target-URI"))
                rows["payload_bytes"].append(number("X-Payload-Length"))
                rows["payload_digest"].append(digest)
                rows["record_type"].append(kind)
                rows["refers_to"].append(number("X-Refers-To-Page"))
                rows["archive"].append(path)
                rows["offset"].append(at)
            kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "offset": pa.int64()}
            yield pa.record_batch({k: pa.array(v, kinds.get(k, pa.string())) for k, v in rows.items()})


def write_pages(pages: DataFrame, folder: str, params: WarcParams = WarcParams()) -> DataFrame:
    """Archive pages (page_id, url, html) in `folder`; returns (archive, records).

    Null html is empty. Of pages with equal html of at least `revisit_bytes` bytes those with the
    smallest page_id are responses (all rows that repeat it), the others revisit it; smaller ones and
    rows with a null page_id are responses. `folder` must be one all executors share. Other columns
    are not looked at.

    Record ids are unique: rows that repeat an id and its html, and rows without an id, take theirs from
    their place in the archives. A revisit of such rows has no WARC-Refers-To.

    The pairing is found on digests alone. The pages are then dealt by id, never by digest, so a page
    archived a million times is spread like any other rows.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", "html", F.sha1(html).alias("digest"))
    sized = rows.select("page_id", "digest", F.octet_length(html).alias("size"))
    known = sized.where("page_id IS NOT NULL").groupBy("page_id", "digest").agg(
        F.count(F.lit(1)).alias("times"), F.max("size").alias("size")
    )
    known = storage.materialise(known, "known")
    first = known.where(F.col("size") >= params.revisit_bytes).groupBy("digest").agg(
        F.min(F.struct("page_id", "times")).alias("first"), F.count(F.lit(1)).alias("pages")
    )
    first = first.where("pages > 1").select("digest", "first")
    marks = known.join(first, "digest", "left").select(
        "page_id", "digest", F.expr("IF(page_id > first.page_id, first.page_id, NULL)").alias("refers_to"),
        (F.col("times") > 1).alias("repeated"), F.expr("coalesce(first.times = 1, true)").alias("named"),
    ).where("refers_to IS NOT NULL OR repeated")
    marked = rows.join(storage.materialise(marks, "marks"), ["page_id", "digest"], "left").select(
        "page_id", "url", "html", "refers_to",
        (F.col("page_id").isNull() | F.coalesce("repeated", F.lit(False))).alias("repeated"),
        F.coalesce("named", F.lit(True)).alias("named"),
    )
    written = marked.mapInArrow(_written(folder, params), "archive string, records long")
    return storage.materialise(written, "archives")


def read_pages(archives: DataFrame) -> DataFrame:
    """The records of archives (archive), each payload checked against its digest.

    One archive is read by one task; its size is bounded when it is written.
    """
    tasks = spread(archives.count(), 2)
    return archives.select("archive").repartition(tasks).mapInArrow(_read, READ_SCHEMA)


def round_trip(pages: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """Write pages to a new shared folder and read them back."""
    folder = storage.scratch_dir(pages.sparkSession)
    return read_pages(write_pages(pages, folder, params))
