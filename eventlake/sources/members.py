"""Gzip members of an output: integrity, an index of members, chunks as members of shared files, and compaction that copies members as they are.

A file may hold many members, each with a checksum and a length at its end. Files are read as streams in blocks, so
memory does not grow with a member, however large; Spark lists the files and deals them to tasks.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.encoding import encode_json
from eventlake.sources.sinks import _delete, _folder, _replace, keep, written_files

#: Bytes that are read, and decompressed, at once.
BLOCK = 1 << 20
#: Lines and bytes of one Arrow batch, at most about.
BATCH_LINES, BATCH_BYTES = 8192, 4 << 20
#: Compressed bytes that a task reads of chunks in shared files, on average.
READ_BYTES = 4 << 20
#: Compressed bytes of one file that compaction makes, at most, unless a single source is larger.
FILE_BYTES = 512 << 20

MEMBERS = "file string, member long, begins long, length long, lines long, bytes long, ended boolean, problem string"
PLACES = "day string, start long, end long, file string, begins long, length long, lines long"
LINES = "day string, start long, end long, line string, file string"


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it. Spark writes local paths with one or three slashes."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def scan_members(blocks: Iterator[bytes], most: int = BLOCK) -> Iterator[tuple[int, int, int, int, bool, str | None]]:
    """(begins, length, lines, bytes, ends with a break, problem) of the members of a gzip stream.

    The decompressor compares the checksum and the length at the end of each member. A stream that ends inside a member,
    or has other bytes than zeros behind one, has a problem, and nothing is read behind that. An empty stream is not gzip.
    """
    at, member, any_member = 0, None, False
    begins = lines = size = 0
    last = b"\n"

    def found(problem: str | None) -> tuple:
        return begins, at - begins, lines, size, last == b"\n", problem

    for block in blocks:
        data, full = block, False
        while data or full:
            if member is None:
                kept = data.lstrip(b"\0") if any_member else data  # zeros behind a member are padding
                at, data = at + len(data) - len(kept), kept
                if not data:
                    break
                member, begins, lines, size, last, any_member = zlib.decompressobj(31), at, 0, 0, b"\n", True
            try:
                out = member.decompress(data, most)
            except zlib.error as error:
                yield found(str(error))
                return
            lines, size, last = lines + out.count(b"\n"), size + len(out), out[-1:] or last
            rest = member.unused_data if member.eof else member.unconsumed_tail
            # A full buffer may leave more to come out, without any further input.
            at, data, full = at + len(data) - len(rest), rest, len(out) == most and not member.eof
            if member.eof:
                lines += last != b"\n"
                yield found(None)
                member = None
    if member is not None:
        yield found("the stream ends inside a member")
    elif not any_member:
        yield found("the file is empty")


def _blocks(path: str) -> Iterator[bytes]:
    system, place = open_path(path)
    with system.open_input_stream(place, compression=None, buffer_size=0) as stream:
        while block := stream.read(BLOCK):
            yield block


def _scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [field.split()[0] for field in MEMBERS.split(", ")]
    for part in parts:
        for file in part["file"]:
            rows = []
            try:
                for number, row in enumerate(scan_members(_blocks(file))):
                    rows.append((file, number, *row))
                    if len(rows) == 10_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            except OSError as error:
                rows.append((file, -1, 0, 0, 0, 0, True, str(error)))
            yield pd.DataFrame(rows, columns=names)


def listed_files(spark: SparkSession, path: str, pattern: str = "*.gz") -> DataFrame:
    """file and size of what lies below a path; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return listed.select(F.col("path").alias("file"), F.col("length").alias("size"))


def gzip_members(spark: SparkSession, path: str) -> DataFrame:
    """The members of all gzip files below a path, in order, with what is wrong with them.

    ``begins`` and ``length`` are places in the compressed file; ``ended`` says whether the last line has its break.
    """
    files = listed_files(spark, path)
    # Few files lie in a partition by default; each is a stream of its own, so they are dealt out.
    return files.repartition("file").select("file").mapInPandas(_scan, MEMBERS)


def damaged_folders(spark: SparkSession, path: str) -> DataFrame:
    """path (as in a manifest) and problem: folders of an output with a file that is no whole gzip stream."""
    wrong = gzip_members(spark, path).where("problem IS NOT NULL")
    return wrong.groupBy(_folder(F.col("file")).alias("path")).agg(F.min("problem").alias("problem"))


def checked_files(spark: SparkSession, path: str) -> DataFrame:
    """:func:`~eventlake.sources.sinks.written_files`, with the problem of folders whose files are not whole."""
    return written_files(spark, path).join(damaged_folders(spark, path), "path", "left")


# -- chunks in shared files ---------------------------------------------------------------------


class _DayFile:
    """A file of a day, with a gzip member for each run of lines of a chunk; it gets its name when it is whole."""

    def __init__(self, out: str, day: str):
        name = uuid.uuid4().hex
        self.file, self.day = f"day={day}/{name}.gz", day
        self.system, folder = open_path(f"{out}/day={day}")
        self.system.create_dir(folder, recursive=True)
        self.beside, self.target = f"{folder}/.{name}", f"{folder}/{name}.gz"
        self.stream = self.system.open_output_stream(self.beside, compression=None)
        self.chunk, self.at, self.places = None, 0, []

    def add(self, chunk: tuple[int, int], lines: int, data: memoryview) -> None:
        if chunk != self.chunk:
            self._end()
            self.chunk, self.packer, self.begins, self.lines = chunk, zlib.compressobj(6, zlib.DEFLATED, 31), self.at, 0
        self.lines += lines
        self._put(self.packer.compress(data))

    def _put(self, raw: bytes) -> None:
        self.stream.write(raw)
        self.at += len(raw)

    def _end(self) -> None:
        if self.chunk:
            self._put(self.packer.flush())
            self.places.append((self.day, *self.chunk, self.file, self.begins, self.at - self.begins, self.lines))

    def close(self) -> pd.DataFrame:
        self._end()
        self.stream.close()
        self.system.move(self.beside, self.target)
        return pd.DataFrame(self.places, columns=[field.split()[0] for field in PLACES.split(", ")])

    def drop(self) -> None:
        self.stream.close()
        self.system.delete_file(self.beside)


def _write_chunks(out: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                day, line = batch.column("day"), batch.column("line")
                start, end = (batch.column(c).to_numpy() for c in ("start", "end"))
                codes = day.dictionary_encode().indices.to_numpy()
                new = (np.diff(start) != 0) | (np.diff(end) != 0) | (np.diff(codes) != 0)
                cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(start)]
                width = np.int64 if pa.types.is_large_string(line.type) else np.int32
                # Each line has its break, so the lines of a run are one piece of the column's bytes.
                bounds = np.frombuffer(line.buffers()[1], width)[line.offset : line.offset + len(line) + 1]
                raw = memoryview(line.buffers()[2])
                for a, b in zip(cuts, cuts[1:]):
                    name = day[a].as_py()
                    if file is None or file.day != name:
                        if file is not None:
                            yield pa.RecordBatch.from_pandas(file.close(), preserve_index=False)
                            file = None
                        file = _DayFile(out, name)
                    file.add((int(start[a]), int(end[a])), b - a, raw[bounds[a] : bounds[b]])
            if file is not None:
                done, file = file.close(), None
                yield pa.RecordBatch.from_pandas(done, preserve_index=False)
        finally:
            if file is not None:
                file.drop()

    return work


def write_members(assigned: DataFrame, path: str, fields: list[str] | None = None) -> None:
    """Events with their chunk as gzip NDJSON under ``day=...``, for plans of many small chunks: they share files.

    Each chunk is a gzip member of its own (a hot one several), and an index in ``_chunks`` has its place, so that
    :func:`read_members` finds it without reading others. Rows are dealt by the hour in which their chunk begins: a day has
    at most 24 files, unless Spark splits an hour that is too large for one task. Files that the index does not name, as
    of a task that ran twice, are never read by it. Null fields are left out, as in :func:`~eventlake.sources.sinks.write_ndjson`.
    """
    line = F.concat(F.coalesce(encode_json(assigned, fields), F.lit("")), F.lit("\n"))
    lines = assigned.select(F.col("chunk_day").alias("day"), F.col("chunk_start").alias("start"), F.col("chunk_end").alias("end"), line.alias("line"))
    dealt = lines.withColumn("hour", F.floor(F.col("start") / 3600)).hint("rebalance", F.col("day"), F.col("hour")).drop("hour")
    dealt.sortWithinPartitions("day", "start", "end").mapInArrow(_write_chunks(path.rstrip("/")), PLACES).write.parquet(f"{path.rstrip('/')}/_chunks")


def member_places(spark: SparkSession, path: str) -> DataFrame:
    """day, start, end, file, begins, length and lines of the chunks that :func:`write_members` wrote."""
    return spark.read.schema(PLACES).parquet(f"{path.rstrip('/')}/_chunks")


def _member_lines(stream, file: str, begins: int, length: int) -> Iterator[list[bytes]]:
    stream.seek(begins)
    member, rest = zlib.decompressobj(31), b""
    while length and (data := stream.read(min(length, BLOCK))):
        length, full = length - len(data), False
        while data or full:
            out = member.decompress(data, BLOCK)
            # A full buffer may leave more to come out, without any further input.
            data, full = member.unconsumed_tail, len(out) == BLOCK and not member.eof
            *whole, rest = (rest + out).split(b"\n")
            yield whole
    if length or not member.eof or member.unused_data:
        raise EOFError(f"{file} has no whole member of that length at {begins}")
    if rest:
        yield [rest]


def _read_chunks(out: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, runs, held = [], [], 0
        name = stream = None

        def batch() -> pa.RecordBatch:
            counts = [n for _, n in runs]
            column = lambda k, kind: pa.array([r[k] for r, _ in runs], kind).take(pa.array(np.repeat(np.arange(len(runs)), counts)))
            # Bytes as they are in the file, as where Spark reads text.
            text = pa.array(lines, pa.binary()).view(pa.string())
            return pa.RecordBatch.from_arrays([column("day", pa.string()), column("start", pa.int64()), column("end", pa.int64()), text, column("file", pa.string())], ["day", "start", "end", "line", "file"])

        try:
            for places in batches:
                for row in places.to_pylist():
                    if row["file"] != name:
                        if stream is not None:
                            stream.close()
                        name = row["file"]
                        system, place = open_path(f"{out}/{name}")
                        stream = system.open_input_file(place)
                    for found in _member_lines(stream, name, row["begins"], row["length"]):
                        lines += found
                        runs.append((row, len(found)))
                        held += sum(map(len, found))
                        if len(lines) >= BATCH_LINES or held >= BATCH_BYTES:
                            yield batch()
                            lines, runs, held = [], [], 0
            if lines:
                yield batch()
        finally:
            if stream is not None:
                stream.close()

    return work


def read_members(spark: SparkSession, path: str, places: DataFrame | None = None) -> DataFrame:
    """day, start, end, line and file of chunks in shared files; ``places`` are some of :func:`member_places`, or all.

    Members are read from their places, so that parts of a file may go to several tasks. One that is not whole is an error.
    """
    places = member_places(spark, path) if places is None else places
    size = places.agg(F.sum("length")).first()[0] or 0
    dealt = places.repartitionByRange(int(size // READ_BYTES + 1), "file", "begins").sortWithinPartitions("file", "begins")
    return dealt.mapInArrow(_read_chunks(path.rstrip("/")), LINES)


# -- compaction ---------------------------------------------------------------------------------


def _join_files(out: str):
    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for day, number, files in zip(part["day"], part["number"], part["files"]):
                system, folder = open_path(f"{out}/day={day}")
                system.create_dir(folder, recursive=True)
                target = f"{folder}/days-{number:06d}.gz"
                beside = f"{target}.{uuid.uuid4().hex}"  # a task that is run again, or twice, writes another one
                with system.open_output_stream(beside, compression=None) as sink:
                    for file in files:
                        for block in _blocks(file):
                            sink.write(block)
                system.move(beside, target)
                yield pd.DataFrame({"day": [day], "number": [number], "sources": [len(files)]})

    return work


def compact_members(spark: SparkSession, path: str, out: str, chunks: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rewrite days as few files by joining the gzip members of their chunks in order; (day, lines).

    Nothing is decompressed for the copy. Refuses while a leaf is not done. Members are checked where they come from,
    and again beside ``out``: each must be whole, and the lines of a day must be those of the manifest. Only then do the
    new files take the place of ``out``. Days get several files, in the order of chunks, of about ``file_bytes``. ``chunks``
    is as for :func:`~eventlake.sources.sinks.compact_days`.
    """
    if not chunks.where("status NOT IN ('done', 'split')").isEmpty():
        raise ValueError("not every chunk is done")
    folder = _folder(F.col("file"))
    place = lambda pattern: F.regexp_extract(folder, pattern, 1)
    files = listed_files(spark, path).select("file", "size", place(r"day=([^/]+)").alias("day"), place(r"chunk=(-?\d+)-").cast("long").alias("start"))
    # The files of a day: places in the compressed day follow from sizes alone. Days have few files beside their rows.
    ordered = files.groupBy("day").agg(F.array_sort(F.collect_list(F.struct("start", "file", "size"))).alias("f"))
    upto = F.aggregate(
        "f",
        F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("at")),
        lambda acc, x: F.struct((acc["sum"] + x["size"]).alias("sum"), F.concat(acc["at"], F.array(F.floor(acc["sum"] / file_bytes))).alias("at")),
    )
    dealt = ordered.select("day", F.posexplode(F.arrays_zip(F.col("f.file").alias("file"), upto["at"].alias("number"))).alias("place", "x"))
    groups = dealt.groupBy("day", F.col("x.number").alias("number")).agg(F.array_sort(F.collect_list(F.struct("place", F.col("x.file").alias("file")))).alias("f"))
    groups = groups.select("day", "number", F.col("f.file").alias("files"))
    source = keep(gzip_members(spark, path), "members")
    wrong = source.where("problem IS NOT NULL OR NOT ended").limit(5).collect()
    if wrong:
        raise ValueError(f"files are damaged: {wrong}")
    beside = f"{out.rstrip('/')}.{uuid.uuid4().hex}"
    keep(groups.repartition("day", "number").mapInPandas(_join_files(beside), "day string, number long, sources long"), "joined")
    made = gzip_members(spark, beside).groupBy(place(r"day=([^/]+)").alias("day")).agg(
        F.sum("lines").alias("lines"), F.count_if(F.col("problem").isNotNull()).alias("wrong")
    )
    expected = chunks.where("status = 'done'").groupBy("day").agg(F.sum(F.col("written") + F.coalesce("multiline", F.lit(0))).alias("expected"))
    none = F.lit(0).cast("long")
    counted = expected.join(made, "day", "full_outer").select("day", *[F.coalesce(c, none).alias(c) for c in ("expected", "lines", "wrong")])
    counted = keep(counted, "counted")
    off = counted.where("expected <> lines OR wrong > 0").limit(5).collect()
    if off:
        _delete(spark, beside)
        raise ValueError(f"line counts differ after compaction: {off}")
    _replace(spark, beside, out)
    return counted.select("day", "lines")


def copy_altered(spark: SparkSession, path: str, out: str, cut: Column, flip: Column) -> None:
    """Copy the files of an output, of some of them without their last ``cut`` bytes, or with the byte ``flip`` places before the end changed.

    For tests of integrity; ``cut`` and ``flip`` are columns over ``file`` and ``start`` (the chunk's), null for none.
    """
    name = F.regexp_extract(F.regexp_replace("file", "%3A", ":"), r"(day=.*)$", 1)
    files = listed_files(spark, path).select("file", name.alias("name"), F.regexp_extract("file", r"chunk=(-?\d+)-", 1).cast("long").alias("start"))

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for file, name, cut, flip in zip(part["file"], part["name"], part["cut"], part["flip"]):
                raw = bytearray(b"".join(_blocks(file)))
                if not pd.isna(flip):
                    raw[-int(flip)] ^= 1
                raw = raw[: len(raw) - (0 if pd.isna(cut) else int(cut))]
                system, target = open_path(f"{out}/{name}")
                system.create_dir(target.rpartition("/")[0], recursive=True)
                with system.open_output_stream(target, compression=None) as sink:
                    sink.write(bytes(raw))
            yield part[["file"]]

    keep(files.select("file", "name", cut.cast("long").alias("cut"), flip.cast("long").alias("flip")).repartition("file").mapInPandas(work, "file string"), "copied")
