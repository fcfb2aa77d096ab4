"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, several records in each,
followed by a seek table in a skippable frame, in the seekable format: per
frame its compressed and its plain size, then a footer. A reader that knows the
frame and the place within its plain bytes gets a record by decompressing one
frame only. Each bundle's index maps record identifiers to these places.

A payload that occurs several times is stored once, in the record with the
smallest page id; the others are revisit records that refer to it.

Tasks write their bundles under names of their own and report them; only what a
finished task reported is in the index, so a lost or repeated task leaves at
most a file that nobody reads.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlens.llm.common import new_path, written

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
#: A fixed date keeps archives of equal pages equal.
DATE = "2024-01-01T00:00:00Z"
INDEX = "record_id string, page_id bigint, bundle string, frame int, offset bigint, size bigint"
READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id: int | None) -> str:
    """The same for a page at any time; one of its own for every page without an id."""
    named = uuid.uuid4() if page_id is None else uuid.uuid5(uuid.NAMESPACE_OID, f"page {page_id}")
    return f"<urn:uuid:{named}>"


def header_value(text: str) -> str:
    """A value that stays on its line."""
    return "".join(c if c >= " " else f"%{ord(c):02X}" for c in text)


def make_record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, name: str | None = None
) -> bytes:
    """A response record with its payload, or a revisit record without."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + (b"\r\n" if revisit else b"Content-Length: %d\r\n\r\n" % len(payload) + payload)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", name or record_name(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", header_value(url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        *([] if page_id is None else [("X-Page-Id", str(page_id))]),
    ]
    if revisit:
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_name(refers_to)),
            ("X-Refers-To-Page-Id", str(refers_to)),
        ]
    headers.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, rest = record.split(b"\r\n\r\n", 1)
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    return headers, block.split(b"\r\n\r\n", 1)[1]


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """Skippable frame with (compressed, plain) sizes of the frames before it."""
    entries = b"".join(struct.pack("<II", *s) for s in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def read_seek_table(tail: bytes) -> list[tuple[int, int]] | int:
    """Frame sizes from the end of a bundle, or how many bytes of the end are needed for them."""
    frames, flags, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    need = frames * entry + 9
    if len(tail) < need:
        return need
    table = tail[len(tail) - need : -9]
    return [struct.unpack_from("<II", table, i * entry) for i in range(frames)]


class BundleWriter:
    """Groups records into frames of at least ``frame_bytes`` plain bytes."""

    def __init__(self, out, frame_bytes: int, level: int):
        self.out, self.frame_bytes = out, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.records: list[bytes] = []
        self.plain = 0
        self.sizes: list[tuple[int, int]] = []

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset within its plain bytes."""
        place = (len(self.sizes), self.plain)
        self.records.append(record)
        self.plain += len(record)
        if self.plain >= self.frame_bytes:
            self._end_frame()
        return place

    def _end_frame(self) -> None:
        if self.records:
            frame = self.compressor.compress(b"".join(self.records))
            self.out.write(frame)
            self.sizes.append((len(frame), self.plain))
            self.records, self.plain = [], 0

    def close(self) -> None:
        self._end_frame()
        self.out.write(seek_table(self.sizes))


class BundleReader:
    """Random access to the records of a bundle; one frame is in memory at a time."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        tail = self._at(max(0, size - 4096), min(size, 4096))
        sizes = read_seek_table(tail)
        if isinstance(sizes, int):
            sizes = read_seek_table(self._at(size - sizes, sizes))
        self.places, start = [], 0
        for compressed, plain in sizes:
            self.places.append((start, compressed, plain))
            start += compressed
        self.frame, self.bytes = -1, b""

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def record(self, frame: int, offset: int, size: int) -> bytes:
        if frame != self.frame:
            start, compressed, plain = self.places[frame]
            self.bytes = zstandard.ZstdDecompressor().decompress(self._at(start, compressed), max_output_size=plain)
            self.frame = frame
        return self.bytes[offset : offset + size]


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a folder given as path or URI."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def with_targets(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, payload and, for records that repeat a payload of at least ``least_bytes``, refers_to.

    Only digests and ids are grouped; one digest may hold any share of the pages,
    as the join to its first page is one that Spark splits.
    """
    payload: Column = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), payload.alias("payload"))
    own = own.withColumn("digest", F.sha1("payload")).withColumn("long", F.octet_length("payload") >= least_bytes)
    first = (
        own.filter("long")
        .groupBy("digest")
        .agg(F.min("page_id").alias("target"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1 and target is not null")
        .drop("times")
    )
    refers = F.when(F.col("long") & (F.col("page_id") != F.col("target")), F.col("target"))
    return own.join(first, "digest", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, frame_bytes: int = 1 << 18, level: int = 3) -> DataFrame:
    """Write bundles below ``folder``, a path or URI that all executors see; returns their index.

    The frame is the first or ends once it holds ``frame_bytes``, so a record
    longer than that has a frame to itself or ends one.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        bundle, out, writer = f"{uuid.uuid4().hex}.warc.zst", None, None
        for rows in batches:
            found = []
            targets = rows["refers_to"].astype("Int64")
            for page_id, url, payload, target in zip(
                rows["page_id"].astype("Int64"), rows["url"], rows["payload"], targets, strict=True
            ):
                if writer is None:
                    out = files.open_output_stream(f"{base}/{bundle}", compression=None)
                    writer = BundleWriter(out, frame_bytes, level)
                page_id = None if pd.isna(page_id) else int(page_id)
                target, name = None if pd.isna(target) else int(target), record_name(page_id)
                record = make_record(page_id, url, payload, payload_digest(payload), target, name)
                found.append((name, page_id, bundle, *writer.add(record), len(record)))
            frame = pd.DataFrame(found, columns=["record_id", "page_id", "bundle", "frame", "offset", "size"])
            frame["page_id"] = frame["page_id"].astype("Int64")
            yield frame
        if writer is not None:
            writer.close()
            out.close()

    return written(with_targets(pages, least_bytes).mapInPandas(write, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Read the indexed records back from their bundles, in any split of the index.

    Responses carry length and digest of the payload as read; revisits those of
    the header, with the length missing.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = open_folder(folder)
        name, reader, file = None, None, None
        for rows in batches:
            found = []
            for bundle, frame, offset, size in zip(rows["bundle"], rows["frame"], rows["offset"], rows["size"], strict=True):
                if bundle != name:
                    if file is not None:
                        file.close()
                    file = files.open_input_file(f"{base}/{bundle}")
                    name, reader = bundle, BundleReader(file)
                headers, payload = parse_record(reader.record(int(frame), int(offset), int(size)))
                stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                kind, page_id = headers["WARC-Type"], headers.get("X-Page-Id")
                response = kind == "response"
                if response and payload_digest(payload) != stated:
                    raise ValueError(f"payload of {page_id} does not have its digest")
                found.append(
                    (
                        None if page_id is None else int(page_id),
                        len(payload) if response else None,
                        stated,
                        kind,
                        None if response else int(headers["X-Refers-To-Page-Id"]),
                        payload if response and payloads else None,
                    )
                )
            frame = pd.DataFrame(found, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
            for column in ("page_id", "payload_bytes", "refers_to"):
                frame[column] = frame[column].astype("Int64")
            yield frame
        if file is not None:
            file.close()

    return index.mapInPandas(read, READ)


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all pages and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null and empty html is an empty payload. A null url is an empty one, a page
    without id gets a record of its own (id null when read) and is referred to
    by none unless all pages with its payload lack an id. Pages that repeat an
    id and payload are one response each. No pages give no rows; other columns
    are ignored. A revisit's length is looked up in the record it refers to.
    """
    folder = new_path(pages.sparkSession, "warc")
    index = write_archives(pages, folder, least_bytes)
    records = read_records(index, folder, payloads=False).drop("payload")
    records = written(records, "warc-read")
    answers = (
        records.filter("record_type = 'response'")
        .groupBy(F.col("page_id").alias("target"), F.col("payload_digest").alias("of"))
        .agg(F.max("payload_bytes").alias("length"))
    )
    met = (F.col("refers_to") == F.col("target")) & (F.col("payload_digest") == F.col("of"))
    return records.join(answers, met, "left").select(
        "page_id",
        F.coalesce("payload_bytes", "length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
