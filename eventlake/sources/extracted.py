"""The Spark data source ``chunk_lines``: an output that is planned from its manifest.

Reading takes the files that the manifest records for done chunks, each a partition of its own; filters on day, start and
end skip chunks before anything is opened. Files that no version of the manifest names (strays, halves of a write that failed,
copies of a task that ran twice) are never read. Writing makes gzip lines by chunk and returns what each file holds;
:func:`write_chunks` puts that into the manifest as one version.

Files are read and written as streams in blocks, on any file system that Arrow opens.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage,
)

from eventlake.sources.manifest import Change, Manifest
from eventlake.sources.members import BLOCK, _blocks, open_path
from eventlake.sources.sinks import keep, scratch_dir

SCHEMA = "chunk long, day string, start long, end long, file string, line string"
WRITTEN = "chunk long, day string, start long, end long, line string"
#: Lines of one Arrow batch, and of one file.
BATCH_LINES = 8192
FILE_LINES = 1_000_000

RECORD = pa.schema([
    ("chunk", pa.int64()), ("file", pa.string()), ("lines", pa.int64()), ("bytes", pa.int64()), ("hash_sum", pa.string()), ("hash_xor", pa.int64()),
])


@dataclass
class File(InputPartition):
    chunk: int
    day: str
    start: int
    end: int
    file: str


def _text(system, path: str) -> bytes:
    with system.open_input_stream(path) as stream:
        return stream.read()


def _rows(path: str, version: int | None) -> list[dict]:
    """The chunks of a manifest, as :class:`Manifest` reads them, without a Spark session (sources are planned outside of it)."""
    system, place = open_path(path)
    from pyarrow import fs

    names = [i.base_name for i in system.get_file_info(fs.FileSelector(f"{place}/commits"))]
    known = sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))
    upto = [v for v in known if version is None or v <= version]
    if not upto or (version is not None and version not in known):
        raise ValueError(f"there is no version {version} of {path}")
    folders: list[str] = []
    for v in reversed(upto):
        entry = json.loads(_text(system, f"{place}/commits/{v:012d}.json"))
        folders += entry["chunks"]  # the latest first
        if entry["whole"]:
            break
    rows: dict[int, dict] = {}
    for folder in folders:
        found = pq.read_table(f"{place}/{folder}", filesystem=system, columns=["id", "day", "start", "end", "status", "files"])
        for row in found.to_pylist():
            rows.setdefault(row["id"], row)
    return list(rows.values())


_TESTS = {EqualTo: lambda a, b: a == b, In: lambda a, b: a in b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b}


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.manifest, self.tests = options["manifest"], []
        self.version = int(options["version"]) if "version" in options else None

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if type(f) in _TESTS and f.attribute in (("day",), ("start",), ("end",), ("chunk",)):
                self.tests.append((f.attribute[0], _TESTS[type(f)], f.value))
            else:
                yield f

    def partitions(self) -> list[File]:
        found = []
        for row in _rows(self.manifest, self.version):
            values = {"day": row["day"], "start": row["start"], "end": row["end"], "chunk": row["id"]}
            if row["status"] == "done" and all(test(values[name], value) for name, test, value in self.tests):
                found += [File(row["id"], row["day"], row["start"], row["end"], f["file"]) for f in row["files"]]
        return sorted(found, key=lambda p: (p.start, p.file))

    def read(self, partition: File | None) -> Iterator[pa.RecordBatch]:
        # Without partitions, Spark asks once for none.
        for lines in _line_batches(partition.file) if partition else ():
            n = len(lines)
            same = lambda value, kind: pa.array([value] * n, kind)  # noqa: B023, E731
            columns = [same(partition.chunk, pa.int64()), same(partition.day, pa.string()), same(partition.start, pa.int64()), same(partition.end, pa.int64()), same(partition.file, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.string())], ["chunk", "day", "start", "end", "file", "line"])


def _line_batches(file: str) -> Iterator[list[str]]:
    """Lines, ending at ``\\n`` only; a file that is not whole is an error."""
    rest, lines, member = b"", [], None
    for block in _blocks(file):
        while block:
            member = member or zlib.decompressobj(31)
            out = member.decompress(block)
            block = member.unused_data
            if member.eof:
                member = None
            *whole, rest = (rest + out).split(b"\n")
            lines += [line.decode() for line in whole]
            while len(lines) >= BATCH_LINES:
                yield lines[:BATCH_LINES]
                lines = lines[BATCH_LINES:]
    if member is not None:
        raise EOFError(f"{file} ends inside a gzip member")
    if rest:
        lines.append(rest.decode())
    if lines:
        yield lines


@dataclass
class _Files(WriterCommitMessage):
    records: list[tuple]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.record = options["path"].rstrip("/"), options["record"]

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Files:
        """One file for each run of rows of a chunk in a task, with a name of its own."""
        records, current, key = [], None, None
        for batch in batches:
            for row in batch.to_pylist():
                k = (row["chunk"], row["day"], row["start"], row["end"])
                if key != k or current.lines >= FILE_LINES:
                    if current:
                        records.append(current.close())
                    key = k
                    current = _Sink(f"{self.path}/day={k[1]}/chunk={k[2]}-{k[3]}/{uuid.uuid4().hex}.gz", k[0])
                current.add(row["line"])
        if current:
            records.append(current.close())
        return _Files(records)

    def commit(self, messages: list[_Files | None]) -> None:
        rows = [r for m in messages if m for r in m.records]
        system, place = open_path(self.record)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        with system.open_output_stream(place) as sink:
            pq.write_table(pa.Table.from_pylist([dict(zip(RECORD.names, r)) for r in rows], RECORD), sink)

    def abort(self, messages: list[_Files | None]) -> None:
        for file in [r[1] for m in messages if m for r in m.records]:
            system, place = open_path(file)
            system.delete_file(place)


class _Sink:
    """A gzip file of lines, with their count, bytes and the hashes that the manifest keeps."""

    def __init__(self, file: str, chunk: int):
        self.file, self.chunk, self.lines, self.bytes, self.sum, self.xor = file, chunk, 0, 0, 0, 0
        system, place = open_path(file)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.stream, self.packer, self.waiting, self.held = system.open_output_stream(place, compression=None), zlib.compressobj(6, zlib.DEFLATED, 31), [], 0

    def add(self, line: str | None) -> None:
        raw = (line or "").encode()
        h = xxhash.xxh64_intdigest(raw, 42)  # as Spark's xxhash64
        h -= (h >> 63) << 64
        self.lines, self.bytes, self.sum, self.xor = self.lines + 1, self.bytes + len(raw) + 1, self.sum + h, self.xor ^ h
        self.waiting.append(raw)
        self.held += len(raw)
        if self.held >= BLOCK:
            self._flush()

    def _flush(self) -> None:
        if self.waiting:
            self.stream.write(self.packer.compress(b"\n".join(self.waiting) + b"\n"))
        self.waiting, self.held = [], 0

    def close(self) -> tuple:
        self._flush()
        self.stream.write(self.packer.flush())
        self.stream.close()
        return self.chunk, self.file, self.lines, self.bytes, str(self.sum), int(np.int64(self.xor))


class ChunkLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "chunk_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)


def read_chunks(spark: SparkSession, manifest: Manifest, version: int | None = None) -> DataFrame:
    """chunk, day, start, end, file and line of the done chunks of a version; filters on the first four prune files."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ChunkLines)
    reader = spark.read.format("chunk_lines").option("manifest", manifest.path)
    return (reader if version is None else reader.option("version", version)).load()


def write_chunks(lines: DataFrame, out: str, manifest: Manifest, now: int, written: DataFrame | None = None) -> int:
    """Write lines (chunk, day, start, end, line) of running chunks and commit their files; the version of the manifest.

    The task that writes a chunk's rows is chosen by Spark: rows are rebalanced by chunk. All running chunks of the lines
    become done; ``written`` (id, written) tells how many rows they should have, and those with other counts become ``mismatch``.
    """
    spark = lines.sparkSession
    spark.dataSource.register(ChunkLines)
    record = f"{scratch_dir(spark, 'record')}/files.parquet"
    rows = lines.select(*[field.split()[0] for field in WRITTEN.split(", ")])
    # Sorted by chunk within a task, so that a chunk's rows are one run.
    rows.hint("rebalance", F.col("chunk")).sortWithinPartitions("chunk").write.format("chunk_lines").mode("append").option("path", out).option("record", record).save()
    made = spark.read.parquet(record)
    files = made.groupBy(F.col("chunk").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("file", "lines", "bytes", F.col("hash_sum").cast("decimal(38,0)").alias("hash_sum"), "hash_xor"))).alias("files"),
        F.sum("lines").alias("written"),
    )
    files = files if written is None else written.select("id", F.col("written").alias("should")).join(files, "id", "full_outer")
    should = F.lit(None).cast("long") if written is None else F.col("should")
    n = F.coalesce("written", F.lit(0).cast("long"))
    status = F.when(F.coalesce(should != n, F.lit(False)), "mismatch").otherwise("done")
    empty = F.array().cast(manifest.chunks().schema["files"].dataType)
    outcomes = keep(files.select("id", n.alias("written"), F.coalesce("files", empty).alias("files"), status.alias("status")), "outcomes")
    return manifest.finish(outcomes, now)
