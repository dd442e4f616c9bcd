"""WARC records in seekable Zstandard bundles.

Every page becomes a record.  Of records with equal payloads of at least ``MIN_REVISIT`` bytes the
one with the smallest id is a response, the others are revisits that refer to it and carry no payload.
Records are grouped into frames of about ``FRAME_BYTES`` that decompress independently; a bundle of
frames ends in a skippable frame with the table of frame sizes, as the seekable Zstandard format has
it.  An index maps each record to its bundle, frame and offset within the decompressed frame, so
that one record costs the decompression of one frame.

Bundles are rows of a table (name, bytes, index), written and read by Spark's own writers, so that
they lie wherever Spark can write; ``export_bundles`` puts them into files of a mounted folder.

Defined results: a null payload counts as empty, a null URL as an empty target; a row without id is
never referred to unless no equal payload has one, and is a response or revisit like others; of
rows with the same smallest id and equal payload all are responses; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.sources.scratch import materialise

MIN_REVISIT = 100
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 23
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the seekable format and of the revisit profile.
ESCAPED = "X-Target-URI-Escaped"
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BUNDLES = (
    "bundle string, content binary, "
    "records array<struct<record_id: string, frame: int, offset: long, length: long>>"
)
RECORDS = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


def plan_records(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, digest, refers_to``: which records revisit which page.

    Only payloads that occur for several ids are joined; the hot ones are counted before the
    shuffle, and adaptive execution splits them in the join.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    digest = F.sha2(html.cast("binary"), 256)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", digest)
    firsts = (
        rows.where(F.octet_length("html") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
        .select("digest", "first")
    )
    firsts = materialise(firsts, "payloads")
    revisits = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return rows.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(revisits, F.col("first")).alias("refers_to")
    )


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _escaped(url: str) -> str:
    return url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unescaped(url: str) -> str:
    return url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def write_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record with its HTTP head; a revisit keeps the head, with the payload's length."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
    ]
    if url is not None and ("\r" in url or "\n" in url):
        head += [f"WARC-Target-URI: {_escaped(url)}", f"{ESCAPED}: yes"]
    elif url is not None:
        head.append(f"WARC-Target-URI: {url}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    block = http + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}


def _page(record: str) -> int | None:
    name = record.rpartition(":")[2].rstrip(">")
    return None if name == "none" else int(name)


def read_record(data: bytes) -> tuple:
    """The columns of ``RECORDS``; the digest of a response is that of the payload read."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = fields["warc-payload-digest"].removeprefix("sha256:")
    url = fields.get("warc-target-uri")
    common = (_page(fields["warc-record-id"]), _unescaped(url) if ESCAPED.lower() in fields else url)
    if fields["warc-type"] == "revisit":
        length = int(_fields(http)["content-length"])
        return (*common, None, length, declared, "revisit", _page(fields["warc-refers-to"]))
    digest = hashlib.sha256(payload).hexdigest()
    if digest != declared:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    return (*common, payload, len(payload), digest, "response", None)


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *s) for s in sizes)
    body += struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames_of(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and compressed sizes of the frames, from the footer alone."""
    count, _, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end")
    sizes = np.frombuffer(content[-9 - 8 * count : -9], dtype="<u4").reshape(count, 2)
    compressed = sizes[:, 0].astype(np.int64)
    return np.cumsum(compressed) - compressed, compressed


def frame(content: bytes, number: int) -> bytes:
    starts, sizes = frames_of(content)
    return zstandard.ZstdDecompressor().decompress(
        content[int(starts[number]) : int(starts[number] + sizes[number])]
    )


class _Bundle:
    """A bundle in the making."""

    def __init__(self) -> None:
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.open, self.index, self.sizes, self.done = bytearray(), [], [], []
        self.bytes = 0

    def add(self, name: str, record: bytes) -> None:
        self.index.append((name, len(self.sizes), len(self.open), len(record)))
        self.open += record
        self.bytes += len(record)
        if len(self.open) >= FRAME_BYTES:
            self._close()

    def _close(self) -> None:
        if self.open:
            packed = self.packer.compress(bytes(self.open))
            self.sizes.append((len(packed), len(self.open)))
            self.done.append(packed)
            self.open = bytearray()

    def row(self) -> dict:
        self._close()
        content = b"".join(self.done) + seek_table(self.sizes)
        keys = ("record_id", "frame", "offset", "length")
        return {
            "bundle": hashlib.sha256(content).hexdigest()[:32] + ".warc.zst",
            "content": content,
            "records": [dict(zip(keys, r, strict=True)) for r in self.index],
        }


BUNDLE_TYPE = pa.schema(
    [
        ("bundle", pa.string()),
        ("content", pa.binary()),
        (
            "records",
            pa.list_(
                pa.struct(
                    [("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]
                )
            ),
        ),
    ]
)
RECORD_TYPE = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def write_bundles(pages: DataFrame) -> DataFrame:
    """Bundles of all pages, with the index of their records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = _Bundle()
        for batch in batches:
            ids, urls, html, digests, refers = batch.columns
            html = html.cast(pa.large_binary())
            for k in range(batch.num_rows):
                page = ids[k].as_py()
                record = write_record(page, urls[k].as_py(), html[k].as_py(), digests[k].as_py(), refers[k].as_py())
                bundle.add(record_id(page), record)
                if bundle.bytes >= BUNDLE_BYTES:
                    yield pa.RecordBatch.from_pylist([bundle.row()], schema=BUNDLE_TYPE)
                    bundle = _Bundle()
        if bundle.index:
            yield pa.RecordBatch.from_pylist([bundle.row()], schema=BUNDLE_TYPE)

    return plan_records(pages).mapInArrow(run, BUNDLES)


def read_bundles(bundles: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the bundles, found through the seek tables and the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                content = batch.column(0)[k].as_py()
                at, data, rows = -1, b"", []
                for record in sorted(
                    batch.column(1)[k].as_py() or (), key=lambda r: (r["frame"], r["offset"])
                ):
                    if record["frame"] != at:
                        if rows:
                            yield _records(rows, payloads)
                        at, rows = record["frame"], []
                        data = frame(content, at)
                    start = record["offset"]
                    rows.append(read_record(data[start : start + record["length"]]))
                if rows:
                    yield _records(rows, payloads)

    return bundles.select("content", "records").mapInArrow(run, RECORDS)


def _records(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    if not payloads:
        columns[2] = (None,) * len(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, RECORD_TYPE, strict=True)], schema=RECORD_TYPE
    )


def fetch(bundles: DataFrame, page_ids: list[int]) -> DataFrame:
    """The records of a few pages; only the frames that hold them are decompressed."""
    names = [record_id(p) for p in page_ids]
    wanted = F.filter("records", lambda r: r["record_id"].isin(names))
    return read_bundles(
        bundles.select("bundle", "content", wanted.alias("records")).where(F.size("records") > 0)
    )


def export_bundles(bundles: DataFrame, folder: str) -> DataFrame:
    """Write each bundle to a file below ``folder``, which every executor must have mounted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = os.path.join(folder, f".{name}.part")
                with open(part, "wb") as file:
                    file.write(content)
                os.replace(part, os.path.join(folder, name))
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["bundle"])

    return bundles.select("bundle", "content").mapInArrow(run, "bundle string")
