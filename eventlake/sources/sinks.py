"""Writing chunks as dated gzip lines, reading them back, compacting days, and the manifest."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.encoding import encode_json, encode_raw, extra_lines

#: Rows of one file: a hot chunk becomes several files instead of one long task.
ROWS_PER_FILE = 1_000_000


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share.

    Without such a folder, only a local session gets a temporary one; elsewhere, executors would not see it.
    """
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not re.fullmatch(r"local(\[.*)?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = tempfile.mkdtemp(prefix="spark-")
    return f"{place.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: made once, and read by all that follows."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines (day, chunk, line) in folders by day and chunk: the one shuffle of all rows.

    Rows are rebalanced by chunk: Spark joins small chunks in one task, and splits those that are too large
    for one (such as a hot second) by what it measured in the shuffle, whatever their lines are.
    """
    writer = lines.hint("rebalance", F.col("chunk")).write.partitionBy("day", "chunk").option("compression", "gzip").option("lineSep", "\n")
    writer.option("maxRecordsPerFile", ROWS_PER_FILE).text(path)


def _chunk_name(assigned: DataFrame) -> DataFrame:
    return assigned.withColumn("chunk", F.concat_ws("-", F.col("chunk_start").cast("string"), F.col("chunk_end").cast("string")))


def write_ndjson(assigned: DataFrame, path: str, fields: list[str] | None = None) -> None:
    """Events with their chunk as gzip NDJSON under ``day=.../chunk=...``; null fields are left out."""
    line = encode_json(assigned, fields)
    write_lines(_chunk_name(assigned).select(F.col("chunk_day").alias("day"), "chunk", line.alias("line")), path)


def write_raw(assigned: DataFrame, path: str) -> None:
    """Raw events as gzip lines; an event without raw text is an empty line."""
    write_lines(_chunk_name(assigned).select(F.col("chunk_day").alias("day"), "chunk", encode_raw(F.col("_raw")).alias("line")), path)


def read_extracted(spark: SparkSession, path: str, damaged: bool = False) -> DataFrame:
    """Lines with their day, chunk and file; lines end at ``\\n`` only.

    With ``damaged``, what can be read of damaged files is read instead of failing.
    """
    lines = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", damaged).text(path)
    keys = [F.col(c).cast("string").alias(c) for c in ("day", "chunk") if c in lines.columns]
    return lines.select(*keys, F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))


def file_stats(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines and uncompressed bytes (each line with its break) by key."""
    return lines.groupBy(*keys).agg(F.count("*").alias("lines"), F.sum(F.octet_length("line") + 1).alias("bytes"))


def _folder(file: Column) -> Column:
    """The folder of a chunk, as named below the output: ``day=.../chunk=...``."""
    return F.regexp_extract(F.regexp_replace(file, "%3A", ":"), r"(day=[^/]+(?:/chunk=[^/]+)?)/[^/]+$", 1)


def written_files(spark: SparkSession, path: str) -> DataFrame:
    """What lies in the folders of an output: path, files, lines, bytes and an order-insensitive hash of the lines.

    Files that can't be read at all have no lines; of damaged ones, the readable lines count.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(path).select("path")
    found = listed.groupBy(_folder(F.col("path")).alias("path")).agg(F.count("*").alias("files"))
    lines = read_extracted(spark, path, damaged=True).select("line", _folder(F.col("file")).alias("path"))
    h = F.xxhash64("line")
    stats = lines.groupBy("path").agg(
        F.count("*").alias("lines"), F.sum(F.octet_length("line") + 1).alias("bytes"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor(h).alias("hash_xor")
    )
    known = found.join(stats, "path", "left")
    return known.select("path", "files", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("lines", "bytes", "hash_sum", "hash_xor")])


def planned_files(lines: DataFrame) -> DataFrame:
    """What the folders of an output of these lines (day, chunk, line) hold: path, lines, and the hash of the lines."""
    h = F.xxhash64("line")
    path = F.concat(F.lit("day="), "day", F.lit("/chunk="), "chunk")
    return lines.groupBy(path.alias("path")).agg(F.count("*").alias("lines"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor(h).alias("hash_xor"))


def written_counts(assigned: DataFrame) -> DataFrame:
    """What a write adds to the manifest: rows and further physical lines of each chunk."""
    return assigned.groupBy("chunk_start", "chunk_end").agg(F.count("*").alias("written"), F.sum(extra_lines(F.col("_raw"))).alias("multiline"))


def compact_days(spark: SparkSession, path: str, out: str, chunks: DataFrame) -> DataFrame:
    """Rewrite days as few files in the order of chunks; (day, lines), checked against the manifest.

    Refuses while a leaf is not done. The new files are written beside ``out`` and take its place only once
    their lines were counted; if the counts differ, ``out`` stays as it was. ``chunks`` has day, start, status, written and multiline; pass a
    null ``multiline`` for NDJSON. Large days get several files, whose names follow the order.
    """
    if not chunks.where("status NOT IN ('done', 'split')").isEmpty():
        raise ValueError("not every chunk is done")
    lines = read_extracted(spark, path).withColumn("start", F.split("chunk", "-")[0].cast("long"))
    ordered = lines.repartitionByRange("day", "start").sortWithinPartitions("day", "start")
    beside = f"{out.rstrip('/')}.{uuid.uuid4().hex}"
    ordered.select("day", "line").write.partitionBy("day").option("compression", "gzip").option("lineSep", "\n").option(
        "maxRecordsPerFile", ROWS_PER_FILE
    ).text(beside)
    made = read_extracted(spark, beside).groupBy("day").agg(F.count("*").alias("lines"))
    expected = chunks.where("status = 'done'").groupBy("day").agg(F.sum(F.col("written") + F.coalesce("multiline", F.lit(0))).alias("expected"))
    counted = expected.join(made, "day", "full_outer").select("day", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("lines", F.lit(0)).alias("lines"))
    counted = keep(counted, "counted")
    wrong = counted.where("expected <> lines").limit(5).collect()
    if wrong:
        _delete(spark, beside)
        raise ValueError(f"line counts differ after compaction: {wrong}")
    _replace(spark, beside, out)
    return counted.select("day", "lines")


def _hadoop_path(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    made, system = _hadoop_path(spark, path)
    system.delete(made, True)


def _replace(spark: SparkSession, fresh: str, out: str) -> None:
    """Put a verified folder in the place of ``out``; what was there goes only when the new one is in place."""
    new, system = _hadoop_path(spark, fresh)
    target, _ = _hadoop_path(spark, out)
    old, _ = _hadoop_path(spark, f"{out.rstrip('/')}.{uuid.uuid4().hex}")
    there = system.exists(target)
    if there and not system.rename(target, old):
        raise ValueError(f"{out} could not be moved aside")
    if not system.rename(new, target):
        if there:
            system.rename(old, target)
        raise ValueError(f"{fresh} could not be moved to {out}")
    if there:
        system.delete(old, True)


def head(lines: DataFrame, n: int) -> DataFrame:
    """The first lines in the order of chunks; lines of a chunk are ordered by their text."""
    start = F.split("chunk", "-")[0].cast("long")
    return lines.orderBy(start, "line").limit(n)


# -- manifest -----------------------------------------------------------------------------------


def write_manifest(path: str, run: DataFrame, chunks: DataFrame, log: DataFrame) -> None:
    """Run, chunks and log; the run row is written last and makes the manifest valid."""
    chunks.write.parquet(f"{path}/chunks")
    log.write.parquet(f"{path}/log")
    run.write.parquet(f"{path}/run")


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{path}/{name}") for name in ("run", "chunks", "log"))  # type: ignore[return-value]


def append_log(log: DataFrame, path: str) -> None:
    log.withColumn("detail", F.substring("detail", 1, 4000)).write.mode("append").parquet(f"{path}/log")


def check_resume(run: DataFrame, search_hash: str) -> None:
    """A run goes on only with the search that it began with."""
    if run.where(F.col("search_hash") != search_hash).count():
        raise ValueError("the search differs from that of the run")


