"""Queries on a manifest with versions, and on the output that is planned from it, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions import encoding
from eventlake.operators import chunks as ch
from eventlake.plans.event_queries import EVENTS, FIELDS, LINE, PIECE, PIECES, pieces, view
from eventlake.sources import sinks
from eventlake.sources.extracted import read_chunks, write_chunks
from eventlake.sources.manifest import Manifest

QUERIES: dict = {}
ORACLES: dict = {}

NOW = 1_700_000_000


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        ORACLES[name] = sql
        return f

    return add


def made(spark, sf_dir: str) -> tuple[DataFrame, DataFrame, Manifest]:
    """(events, plan with ids from 1, a new manifest of it)."""
    events, plan = pieces(spark, sf_dir)
    _, lo, _ = view(spark, sf_dir)
    plan = sinks.keep(plan.withColumn("id", ((F.col("start") - lo) / PIECE).cast("long") + 1), "plan")
    manifest = Manifest(spark, sinks.scratch_dir(spark, "manifest"))
    manifest.create(spark.range(1).select(F.lit("run").alias("id"), F.lit("hash").alias("search_hash")), plan)
    return events, plan, manifest


@query("manifest_history", f"""WITH {EVENTS}, {PIECES}, k AS (SELECT count(*) AS n FROM pc),
s AS (SELECT unnest([{{'v': 0, 's': 'pending', 'd': 0, 'c': 1, 'a': 0}}, {{'v': 1, 's': 'pending', 'd': -10, 'c': 1, 'a': 0}}, {{'v': 1, 's': 'running', 'd': 10, 'c': 0, 'a': 10}},
  {{'v': 2, 's': 'pending', 'd': -15, 'c': 1, 'a': 0}}, {{'v': 2, 's': 'running', 'd': 15, 'c': 0, 'a': 15}},
  {{'v': 3, 's': 'pending', 'd': -15, 'c': 1, 'a': 0}}, {{'v': 3, 's': 'running', 'd': 5, 'c': 0, 'a': 5}}, {{'v': 3, 's': 'failed', 'd': 3, 'c': 0, 'a': 3}},
  {{'v': 3, 's': 'mismatch', 'd': 4, 'c': 0, 'a': 4}}, {{'v': 3, 's': 'done', 'd': 3, 'c': 0, 'a': 3}},
  {{'v': 4, 's': 'pending', 'd': -11, 'c': 1, 'a': 0}}, {{'v': 4, 's': 'running', 'd': 3, 'c': 0, 'a': 3}}, {{'v': 4, 's': 'split', 'd': 2, 'c': 0, 'a': 2}},
  {{'v': 4, 's': 'failed', 'd': 3, 'c': 0, 'a': 3}}, {{'v': 4, 's': 'mismatch', 'd': 4, 'c': 0, 'a': 4}}, {{'v': 4, 's': 'done', 'd': 3, 'c': 0, 'a': 3}},
  {{'v': 5, 's': 'pending', 'd': -1, 'c': 1, 'a': 0}}, {{'v': 5, 's': 'split', 'd': 2, 'c': 0, 'a': 2}}, {{'v': 5, 's': 'done', 'd': 3, 'c': 0, 'a': 3}}]) AS x)
SELECT x.v::BIGINT AS version, x.s AS status, (x.d + x.c * n)::BIGINT AS chunks, x.a::BIGINT AS attempts FROM s, k""")
def manifest_history(spark, sf_dir):
    """Chunks by status at each version: claimed by two workers, finished, split and put back."""
    _, _, manifest = made(spark, sf_dir)
    manifest.claim("a", 10, NOW)
    newest = sinks.keep(manifest.claim("b", 5, NOW, oldest_first=False), "claimed")
    status = F.when(F.col("id") % 3 == 0, "failed").when(F.col("id") % 3 == 1, "mismatch").otherwise("done")
    manifest.finish(manifest.chunks(1).where("worker = 'a'").select("id", status.alias("status"), F.col("start").alias("written")), NOW + 1)
    halves = newest.orderBy("start").limit(2).select(F.col("id").alias("parent"), "day", F.explode(F.array(F.struct("start", (F.col("start") + PIECE // 2).alias("end")), F.struct((F.col("start") + PIECE // 2).alias("start"), "end"))).alias("h"))
    manifest.split(halves.select("parent", "day", "h.start", "h.end"), NOW + 2)
    manifest.requeue(NOW + 3)
    found = None
    for v in manifest.versions():
        counts = manifest.chunks(v).groupBy(F.lit(v).cast("long").alias("version"), "status").agg(F.count("*").alias("chunks"), F.sum("attempts").alias("attempts"))
        found = counts if found is None else found.unionByName(counts)
    return found


@query("manifest_source", f"""WITH {EVENTS}, {PIECES}, k AS (SELECT day, start, (start - lo) // {PIECE} + 1 AS id, {LINE} AS line FROM ev JOIN pc ON t >= start AND t < "end", r WHERE (start - lo) // {PIECE} % 7 <> 3)
SELECT id::BIGINT AS chunk, day, count(*)::BIGINT AS lines, sum(strlen(line) + 1)::BIGINT AS bytes FROM k, r WHERE start >= lo + 5 * 86400 AND start < hi - 2 * 86400 GROUP BY id, day""")
def manifest_source(spark, sf_dir):
    """Lines by chunk of some days, from the files that the manifest names: not those of chunks that failed, nor of a second write."""
    events, plan, manifest = made(spark, sf_dir)
    _, lo, hi = view(spark, sf_dir)
    manifest.claim("a", plan.count(), NOW)
    assigned = ch.assign_chunks(events, plan, keys=("id", "start", "end"))
    lines = assigned.select(
        F.col("chunk_id").alias("chunk"), F.col("chunk_day").alias("day"), F.col("chunk_start").alias("start"), F.col("chunk_end").alias("end"), encoding.encode_json(assigned, FIELDS).alias("line")
    )
    out = sinks.scratch_dir(spark, "output")
    sinks.write_lines(lines.select("day", F.concat_ws("-", F.col("start").cast("string"), F.col("end").cast("string")).alias("chunk"), "line"), out)  # strays
    written = ch.chunk_counts(events, plan).select("id", (F.col("n") + F.when((F.col("id") - 1) % 7 == 3, 1).otherwise(0)).alias("written"))
    write_chunks(lines, out, manifest, NOW + 1, written)
    read = read_chunks(spark, manifest).where((F.col("start") >= lo + 5 * 86400) & (F.col("start") < hi - 2 * 86400))
    return read.groupBy("chunk", "day").agg(F.count("*").alias("lines"), F.sum(F.octet_length("line") + 1).alias("bytes"))
