"""Operator 8: WARC archives as a PySpark Python data source.

``spark.read.format("warc").load(folder)`` reads WARC files; ``df.write.format("warc")`` writes them.

* Planning. The files of the folder are packed into partitions of about ``partition_bytes``; a file is
  not split, so the writer starts a new file at ``file_bytes``.
* Pushed predicates. Equality, ``IN`` and ``IS NOT NULL`` on record type, id, target, digest and
  reference are taken over by the reader. The headers of a record are parsed first; a record they reject is skipped by
  its length, without decoding its payload. ``payload=false`` skips every payload.
  Spark 4.1 keeps what was last pushed to a loaded table, so load it anew for a scan without predicates.
* Files are gzip with one member per record. Members carry their compressed length in the ``LX`` extra
  field of archive gzip files, which lets the reader jump to the next member; members without it, and
  plain files, are read too.
* A task writes to a temporary folder of its job, and only the commit moves the files of successful
  attempts and removes that folder, so lost or repeated tasks leave nothing behind. ``overwrite`` removes
  the archive's older files once the new ones are there.
* A record that is cut short or malformed is an error (option ``mode=fail``), is left out (``skip``), or is a
  row of type ``malformed`` with the file as its target and the byte as its id (``mark``). Payloads are only
  checked where they are read, or where marks are asked for. Where the length of
  its member is known, reading goes on behind it, else with the next file.

Paths are those of Arrow's file systems: local and mounted folders, and stores that it opens by URI.

Defined results of the query: a null html is an empty payload; pages with equal payloads are one
response (smallest page_id) and revisits; rows that repeat the smallest id are responses too; a page
without an id is never the smallest unless its group has no ids, and then is a response; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import io
import posixpath
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow.fs as afs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from eventlake.llm.common import BROADCAST_ROWS, cut, new_dir, table

SCHEMA = (
    "record_id string, record_type string, target_uri string, record_date string, payload_digest string, "
    "refers_to string, content_type string, payload_bytes long, payload binary"
)
#: Named fields of a record (fixed by the WARC 1.1 format).
HEADERS = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "record_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "content_type": "Content-Type",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEAD_BYTES = 4096
END = b"\r\n\r\n"


def place(path: str) -> tuple[afs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if re.match(r"file:/(?!/)", path):
        path = path[len("file:") :]
    return afs.FileSystem.from_uri(path) if "://" in path else (afs.LocalFileSystem(), path)


class Malformed(ValueError):
    """A record that can't be read; ``at`` is its first byte."""

    def __init__(self, at: int, why: str) -> None:
        super().__init__(f"record at byte {at} {why}")
        self.at = at


# -- records ------------------------------------------------------------------------------------


def record_bytes(row: dict) -> bytes:
    """A WARC record: headers, HTTP response head, and the payload unless it is a revisit."""
    revisit = row["record_type"] == "revisit"
    payload = b"" if revisit or row["payload"] is None else bytes(row["payload"])
    length = row["payload_bytes"] if revisit and row["payload_bytes"] is not None else len(payload)
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length + payload
    values = dict(row) | {"content_type": row["content_type"] or "application/http; msgtype=response"}
    head = ["WARC/1.1"]
    for name, header in HEADERS.items():
        if values[name] is not None:
            clean = re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", values[name])
            head.append(f"{header}: {clean}")
    if revisit:
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + END + block + END


def gzip_member(record: bytes, level: int) -> bytes:
    """A gzip member whose extra field holds its compressed and uncompressed length."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = deflate.compress(record) + deflate.flush()
    extra = struct.pack("<2sHII", b"LX", 8, 10 + 2 + 12 + len(body) + 8, len(record))
    fixed = struct.pack("<BBBBIBB", 0x1F, 0x8B, 8, 4, 0, 0, 255)
    return fixed + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def parse_head(head: bytes) -> dict[str, str]:
    """Named fields in lower case; the first line is the version."""
    fields: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def _head_end(head: bytes, at: int) -> int:
    edge = head.find(END)
    if edge < 0 or not head.startswith(b"WARC/"):
        raise Malformed(at, "has no WARC header")
    return edge


def _content_length(fields: dict[str, str], at: int) -> int:
    size = fields.get("content-length", "0")
    if not size.isdigit():
        raise Malformed(at, f"has the length {size!r}")
    return int(size)


class _Gzip:
    """The records of a file with one gzip member for each."""

    def __init__(self, file: BinaryIO) -> None:
        self.file = file
        self.at = 0

    def next(self) -> bytes | None:
        """The first bytes of the next record, None at the end; ``rest`` gives all of it, ``skip`` leaves it."""
        self.at = self.file.tell()
        first = self.file.read(HEAD_BYTES)
        if not first:
            return None
        self.length = self._length(first)
        self.inflate = zlib.decompressobj(16 + zlib.MAX_WBITS)
        self.whole: bytes | None = None
        self.head = self._more(first, HEAD_BYTES)
        while END not in self.head and not self.inflate.eof:
            self.head += self._more(self.inflate.unconsumed_tail or self.file.read(HEAD_BYTES), HEAD_BYTES)
        return self.head

    def _more(self, raw: bytes, most: int = 0) -> bytes:
        if not raw:
            raise Malformed(self.at, "is cut short")
        try:
            return self.inflate.decompress(raw, most)
        except zlib.error as error:
            raise Malformed(self.at, f"is not gzip: {error}") from error

    @staticmethod
    def _length(first: bytes) -> int | None:
        if len(first) >= 24 and first[:2] == b"\x1f\x8b" and first[3] & 4 and first[12:14] == b"LX":
            return struct.unpack_from("<I", first, 16)[0]
        return None

    def rest(self) -> bytes:
        if self.whole is None:
            parts = [self.head]
            while not self.inflate.eof:
                parts.append(self._more(self.inflate.unconsumed_tail or self.file.read(1 << 16)))
            self.whole = b"".join(parts)
        return self.whole

    def skip(self) -> None:
        if self.length is None:
            self.rest()
            self.file.seek(self.file.tell() - len(self.inflate.unused_data))
        else:
            self.file.seek(self.at + self.length)

    def recover(self) -> bool:
        """Go behind a malformed record, if that is known."""
        if self.length is None:
            return False
        self.file.seek(self.at + self.length)
        return True


class _Plain:
    """The records of a file that isn't compressed."""

    def __init__(self, file: BinaryIO) -> None:
        self.file = file
        self.at = 0

    def next(self) -> bytes | None:
        self.at = self.file.tell()
        head = self.file.read(HEAD_BYTES)
        while END not in head and (more := self.file.read(HEAD_BYTES)):
            head += more
        if not head.strip():
            return None
        edge = _head_end(head, self.at)
        self.size = edge + 4 + _content_length(parse_head(head[:edge]), self.at) + 4
        return head[: self.size]

    def rest(self) -> bytes:
        self.file.seek(self.at)
        whole = self.file.read(self.size)
        if len(whole) < self.size:
            raise Malformed(self.at, "is cut short")
        return whole

    def skip(self) -> None:
        self.file.seek(self.at + self.size)

    def recover(self) -> bool:
        return False


def read_records(
    path: str, wanted: dict[str, set[str]], with_payload: bool, present: frozenset[str] = frozenset(), mode: str = "fail"
) -> Iterator[tuple]:
    """Rows of a file; ``wanted`` maps columns to the values they may have, ``present`` columns aren't null."""
    system, inner = place(path)
    allowed = lambda row: all(row[n] in v for n, v in wanted.items()) and all(row[n] is not None for n in present)
    malformed = dict.fromkeys(HEADERS) | {"record_id": "0", "record_type": "malformed", "target_uri": path}
    with system.open_input_file(inner) as raw, io.BufferedReader(raw, 1 << 20) as file:
        kind = _Gzip if file.read(2) == b"\x1f\x8b" else _Plain
        file.seek(0)
        records = kind(file)
        while True:
            try:
                head = records.next()
                if head is None:
                    return
                found = _record(records, head, allowed, with_payload, mode == "mark" and allowed(malformed))
                records.skip()
            except Malformed as error:
                if mode == "fail":
                    raise ValueError(f"{path}: {error}") from error
                row = malformed | {"record_id": str(error.at)}
                found = (*row.values(), None, None) if mode == "mark" and allowed(row) else None
                if found:
                    yield found
                if not records.recover():
                    return
                continue
            if found:
                yield found


def _record(records: _Gzip | _Plain, head: bytes, allowed: Callable[[dict], bool], with_payload: bool, check: bool) -> tuple | None:
    """The row of a record, or None if its headers are not wanted; then its payload is not decoded unless ``check``."""
    edge = _head_end(head, records.at)
    fields = parse_head(head[:edge])
    size = _content_length(fields, records.at)
    row = {name: fields.get(header.lower()) for name, header in HEADERS.items()}
    if not allowed(row):
        if check and len(records.rest()) < edge + 4 + size:
            raise Malformed(records.at, "is cut short")
        return None
    http = head[edge + 4 :]
    payload = None
    is_http = (row["content_type"] or "").startswith("application/http")
    if with_payload and row["record_type"] != "revisit":
        block = records.rest()[edge + 4 : edge + 4 + size]
        if len(block) < size:
            raise Malformed(records.at, "is cut short")
        payload = block.partition(END)[2] if is_http else block
    elif is_http and END not in http and size > len(http):
        http = records.rest()[edge + 4 : edge + 4 + size]
    length = len(payload) if payload is not None else size
    if payload is None and is_http:
        stated = parse_head(http.partition(END)[0]).get("content-length")
        length = int(stated) if stated and stated.isdigit() else None
    return (*(row[name] for name in HEADERS), length, payload)


# -- the data source ----------------------------------------------------------------------------


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.bytes = int(options.get("partition_bytes", 64 << 20))
        self.mode = str(options.get("mode", "fail")).lower()
        if self.mode not in ("fail", "skip", "mark"):
            raise ValueError(f"mode is one of fail, skip and mark, not {self.mode!r}")
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.wanted: dict[str, set[str]] = {}
        self.present: frozenset[str] = frozenset()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self._allow(name, {f.value})
            elif name in HEADERS and isinstance(f, In):
                self._allow(name, set(f.value))
            elif name in HEADERS and isinstance(f, IsNotNull):
                self.present |= {name}
            else:
                yield f

    def _allow(self, name: str, values: set) -> None:
        self.wanted[name] = self.wanted.get(name, values) & values

    def partitions(self) -> list[Files]:
        system, inner = place(self.path)
        files = [f for f in system.get_file_info(afs.FileSelector(inner)) if f.is_file and f.base_name.endswith((".warc", ".warc.gz"))]
        found: list[Files] = []
        room = 0
        for file in sorted(files, key=lambda f: f.base_name):
            if not found or file.size > room:
                found.append(Files([]))
                room = self.bytes
            found[-1].paths.append(posixpath.join(self.path, file.base_name))
            room -= file.size
        return found or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        for path in partition.paths:
            yield from read_records(path, self.wanted, self.payload, self.present, self.mode)


@dataclass
class Written(WriterCommitMessage):
    paths: list[str]


class WarcWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path = options["path"]
        self.level = int(options.get("level", 6))
        self.bytes = int(options.get("file_bytes", 64 << 20))
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex

    def _place(self) -> tuple[afs.FileSystem, str, str]:
        system, inner = place(self.path)
        return system, inner, posixpath.join(inner, "_temporary", self.job)

    def write(self, rows: Iterator) -> Written:
        system, _, temporary = self._place()
        system.create_dir(temporary)
        paths: list[str] = []
        out: BinaryIO | None = None
        try:
            for row in rows:
                if out is None or out.tell() >= self.bytes:
                    if out:
                        out.close()
                    paths.append(posixpath.join(temporary, f"part-{uuid.uuid4().hex}.warc.gz"))
                    out = system.open_output_stream(paths[-1], compression=None)
                out.write(gzip_member(record_bytes(row.asDict()), self.level))
        finally:
            if out:
                out.close()
        return Written(paths)

    def commit(self, messages: list) -> None:
        system, inner, _ = self._place()
        system.create_dir(inner)
        older = [f.path for f in system.get_file_info(afs.FileSelector(inner)) if f.is_file and self.overwrite]
        for path in (p for m in messages if m for p in m.paths):
            system.move(path, posixpath.join(inner, posixpath.basename(path)))
        for path in older:
            system.delete_file(path)
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        """Remove what is left of this job, and the temporary folder if no other job uses it."""
        system, inner, temporary = self._place()
        if system.get_file_info(temporary).type == afs.FileType.Directory:
            system.delete_dir(temporary)
        above = posixpath.join(inner, "_temporary")
        if not system.get_file_info(afs.FileSelector(above, allow_not_found=True)) and system.get_file_info(above).type == afs.FileType.Directory:
            system.delete_dir(above)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


# -- archives of pages --------------------------------------------------------------------------


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 5 hexadecimal digits are 4 digits of 5 bits."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


_NO_ID = "<urn:uuid:ffffffff-ffff-ffff-ffff-ffffffffffff>"


def _record_id(page_id: Column) -> Column:
    digits = F.lower(F.lpad(F.hex(page_id), 16, "0"))
    whole = F.concat(F.lit("<urn:uuid:00000000-0000-4000-"), F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 12), F.lit(">"))
    return F.coalesce(whole, F.lit(_NO_ID))


def _page_id(record_id: Column) -> Column:
    digits = F.concat(F.substring(record_id, 30, 4), F.substring(record_id, 35, 12))
    return F.when(record_id != _NO_ID, F.conv(digits, 16, -10).cast("long"))


def page_records(pages: DataFrame, least_bytes: int = 0, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """WARC records of pages; pages that repeat another's payload revisit its record."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("digest", base32_sha1(F.col("payload")))
    groups = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("origin"))
    groups = cut(groups.where("n > 1 AND origin IS NOT NULL").select("digest", "origin"))
    if groups.count() <= broadcast_rows:
        marked = rows.join(F.broadcast(groups), "digest", "left")
    else:  # ids and digests meet first, so that payloads are dealt by page and not by a common digest
        marks = rows.select(F.col("page_id").alias("id"), "digest").join(groups, "digest").select("id", F.col("digest").alias("of"), "origin").distinct()
        marked = rows.join(marks, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left")
    revisit = F.col("origin").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("origin"))
    return marked.select(
        _record_id(F.col("page_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit("2024-01-01T00:00:00Z").alias("record_date"),
        F.concat(F.lit("sha1:"), "digest").alias("payload_digest"),
        F.when(revisit, _record_id(F.col("origin"))).alias("refers_to"),
        F.lit(None).cast("string").alias("content_type"),
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def archive(pages: DataFrame, path: str) -> None:
    register(pages.sparkSession)
    page_records(pages).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One pass: responses are measured from their payloads, revisits from their headers alone."""
    register(spark)
    records = spark.read.format("warc").load(path).where(F.col("record_type").isin("response", "revisit"))
    full = F.col("record_type") == "response"
    return records.select(
        _page_id(F.col("record_id")).alias("page_id"),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(full, base32_sha1(F.col("payload"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        F.when(~full, _page_id(F.col("refers_to"))).alias("refers_to"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "warc")
    archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path)


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
b AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
         translate(array_to_string(list_transform(range(0, 8),
           lambda i: lpad(to_base(('0x' || substr(h, (1 + 5 * i)::BIGINT, 5))::BIGINT, 32), 4, '0')), ''),
           '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
         min(page_id) OVER (PARTITION BY h) AS origin
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = origin THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> origin THEN origin END AS refers_to
FROM b
"""
