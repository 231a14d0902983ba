"""WARC records in ZIP archives: written once, then read by ranges.

An archive holds one stored member of WARC records (each its own gzip member) and
one stored index with a line for each record. The reader never extracts a
member: it parses the end record (ZIP64 too), the central directory and the local
headers, and then reads the index and single records by their byte ranges.
"""

from __future__ import annotations

import base64
import datetime
import io
import json
import re
import struct
import sys
import zipfile
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from firmweave.llm.common import read_files, write_files
from firmweave.operators.relational import lookup

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# an archive is closed when its records reach this size; a reading task holds whole archives
ARCHIVE_BYTES = 12_000_000
REVISIT_BYTES = 1000
ARCHIVE_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.jsonl"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ReadRange = Callable[[int, int], bytes]


@dataclass
class Member:
    name: str
    method: int
    crc: int
    packed_size: int
    size: int
    header_at: int


class ZipRanges:
    """The members of a ZIP archive, by reads of byte ranges only."""

    def __init__(self, read: ReadRange, size: int):
        self.read = read
        count, start, length = self._directory(size)
        self.members = {m.name: m for m in self._entries(read(start, length), count)}

    def _directory(self, size: int) -> tuple[int, int, int]:
        """(entries, offset, bytes) of the central directory."""
        tail_at = max(0, size - 65_557)  # the longest comment and the end record
        tail = bytes(self.read(tail_at, size - tail_at))
        at = len(tail) - 22
        while at >= 0:
            # the last end record whose comment reaches the end of the file
            if tail[at : at + 4] == b"PK\5\6" and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
                break
            at -= 1
        else:
            raise ValueError("no end record: not a ZIP archive")
        count, length, start = struct.unpack_from("<HII", tail, at + 10)
        end_at = tail_at + at
        if end_at >= 20:
            locator = bytes(self.read(end_at - 20, 20))
            if locator[:4] == b"PK\6\7":
                wide_at = struct.unpack_from("<Q", locator, 8)[0]
                wide = bytes(self.read(wide_at, 56))
                if wide[:4] != b"PK\6\6":
                    raise ValueError("damaged ZIP64 end record")
                # values that fit stay in the old record
                wide_count, wide_length, wide_start = struct.unpack_from("<QQQ", wide, 32)
                count = wide_count if count == 0xFFFF else count
                length = wide_length if length == 0xFFFFFFFF else length
                start = wide_start if start == 0xFFFFFFFF else start
        return count, start, length

    def _entries(self, directory: bytes, count: int) -> Iterator[Member]:
        directory, at = bytes(directory), 0
        for _ in range(count):
            if directory[at : at + 4] != b"PK\1\2":
                raise ValueError("damaged central directory")
            flags, method = struct.unpack_from("<HH", directory, at + 8)
            crc, packed, size, n, extra_n, comment_n = struct.unpack_from("<IIIHHH", directory, at + 16)
            header_at = struct.unpack_from("<I", directory, at + 42)[0]
            name = directory[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
            extra, e = directory[at + 46 + n : at + 46 + n + extra_n], 0
            while e + 4 <= len(extra):
                kind, m = struct.unpack_from("<HH", extra, e)
                if kind == 1:  # wide values, for those that are full only, in this order
                    wide = iter(struct.unpack_from(f"<{m // 8}Q", extra, e + 4))
                    size = next(wide) if size == 0xFFFFFFFF else size
                    packed = next(wide) if packed == 0xFFFFFFFF else packed
                    header_at = next(wide) if header_at == 0xFFFFFFFF else header_at
                e += 4 + m
            yield Member(name, method, crc, packed, size, header_at)
            at += 46 + n + extra_n + comment_n

    def start_of(self, name: str) -> int:
        """Where a stored member's bytes begin."""
        member = self.members[name]
        if member.method != 0:
            raise ValueError(f"{name} is not stored, so it has no ranges")
        header = bytes(self.read(member.header_at, 30))
        if header[:4] != b"PK\3\4":
            raise ValueError("damaged local header")
        name_n, extra_n = struct.unpack_from("<HH", header, 26)
        return member.header_at + 30 + name_n + extra_n

    def index(self, name: str = INDEX_MEMBER) -> list[dict]:
        """The index lines."""
        lines = bytes(self.read(self.start_of(name), self.members[name].size))
        return [json.loads(line) for line in lines.splitlines()]

    def record(self, entry: dict) -> tuple[dict[str, str], bytes]:
        """Headers and block of the record an index line points to."""
        raw = self.read(self.start_of(entry["filename"]) + entry["offset"], entry["length"])
        head, _, rest = zlib.decompress(raw, 31).partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        return headers, rest[: int(headers["Content-Length"])]


def _record(kind: str, page_id, url: str | None, payload: bytes, size: int, sha1: str, head, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    headers = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{page_id}>",
        "WARC-Date": date,
        # no character may end the header line
        "WARC-Target-URI": url and re.sub("[\x00-\x20\x7f-\xa0  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode(),
        "WARC-Refers-To": f"<urn:page:{head}>" if kind == "revisit" else None,
        "WARC-Profile": PROFILE if kind == "revisit" else None,
        "X-Payload-Length": str(size),
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None) + "\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(text.encode("utf-8") + block + b"\r\n\r\n") + squeeze.flush()


def pack_archive(records: list[bytes], entries: list[dict]) -> bytes:
    """A ZIP archive without its last byte, a comment of one line feed that the file writer adds."""
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as archive:
        stamp = (1980, 1, 1, 0, 0, 0)
        archive.writestr(zipfile.ZipInfo(ARCHIVE_MEMBER, stamp), b"".join(records))
        archive.writestr(zipfile.ZipInfo(INDEX_MEMBER, stamp), "".join(json.dumps(e) + "\n" for e in entries))
        archive.comment = b"\n"
    return sink.getvalue()[:-1]


def with_revisits(pages: DataFrame, key: str = "page_id", payload: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """``pages`` with ``sha1``, ``size`` and ``head``: the largest key among equal payloads of ``least`` bytes or more.

    ``head`` is null where a record has no equal. Null payloads count as empty.
    """
    sized = pages.withColumn(payload, F.coalesce(payload, F.lit(""))).withColumns(
        {"sha1": F.sha1(payload), "size": F.octet_length(payload).cast("bigint")}
    )
    heads = (
        sized.filter(F.col("size") >= least).groupBy("sha1")
        .agg(F.max(key).alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    )
    return lookup(sized, heads, "sha1", "left")


def write_archives(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
    least: int = REVISIT_BYTES, date: str | None = None, archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """A WARC record for each row, in ZIP archives under ``path``.

    Of records with equal payloads of at least ``least`` bytes, those with the largest key
    are responses (repeated rows share it) and the others, rows without a key too, are revisits of it. A null
    url leaves its header out, a null payload is empty. Other columns are not read. No rows write no archive.
    """
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    plain = pages.select(F.col(key).cast("bigint").alias("key"), F.col(url).alias("url"), F.col(payload).alias("payload"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, entries, at = [], [], 0
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("key", "url", "sha1", "size", "head")]
            payloads = batch.column(batch.schema.get_field_index("payload")).cast(pa.binary())
            for page_id, target, sha1, size, head, body in zip(*(c.to_pylist() for c in columns), payloads):
                kind = "revisit" if head is not None and head != page_id else "response"
                record = _record(kind, page_id, target, body.as_py(), size, sha1, head, date)
                records.append(record)
                entries.append({"id": page_id, "type": kind, "filename": ARCHIVE_MEMBER, "offset": at, "length": len(record)})
                at += len(record)
                if at >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([pack_archive(records, entries)], pa.binary())], ["content"])
                    records, entries, at = [], [], 0
        if records:
            yield pa.RecordBatch.from_arrays([pa.array([pack_archive(records, entries)], pa.binary())], ["content"])

    dealt = with_revisits(plain, "key", "payload", least).withColumn(
        "payload", F.when(F.col("head").isNull() | F.col("head").eqNullSafe(F.col("key")), F.col("payload")).otherwise(F.lit(""))
    )
    write_files(dealt.mapInArrow(pack, "content binary"), "content", path)


def _page(urn: str | None) -> int | None:
    name = urn[len("<urn:page:") : -1] if urn else "None"
    return None if name == "None" else int(name)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, record_type, refers_to, declared_bytes, declared_digest, payload) of every record.

    ``payload`` is null for revisits. Records are read by the ranges of the archive's index.
    """
    fields = "page_id bigint, url string, record_type string, refers_to bigint, declared_bytes bigint, declared_digest string, payload binary"
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(batch.schema.get_field_index("content")):
                bytes_of = memoryview(content.as_buffer())
                archive = ZipRanges(lambda at, n, b=bytes_of: b[at : at + n], len(bytes_of))
                rows, size = [], 0
                for entry in archive.index():
                    headers, block = archive.record(entry)
                    payload = block.partition(b"\r\n\r\n")[2] if headers["WARC-Type"] == "response" else None
                    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    rows.append((
                        _page(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), headers["WARC-Type"],
                        _page(headers.get("WARC-Refers-To")), int(headers["X-Payload-Length"]), digest, payload,
                    ))
                    size += len(payload or b"")
                    if size > 8_000_000:
                        yield as_batch(rows)
                        rows, size = [], 0
                if rows:
                    yield as_batch(rows)

    def as_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)

    return read_files(spark, path).mapInArrow(unpack, fields)
