"""Queries that write chunks, damage some, read the files back and validate them in full.

The chunks are those of six hours, numbered from 1. Those divisible by 23 are not written, those divisible by
19 lack their last event, those divisible by 17 have another last line, and a folder belongs to no chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions import encoding
from eventlake.operators import chunks as ch
from eventlake.plans import validation as va
from eventlake.plans.event_queries import EVENTS, FIELDS, LINE, PIECE, PIECES, pieces, view
from eventlake.sources import members, sinks

QUERIES: dict = {}
ORACLES: dict = {}

DAMAGED = f"""{EVENTS}, {PIECES},
k AS (SELECT *, (start - lo) // {PIECE} + 1 AS id FROM pc, r),
c AS (SELECT id, day, start, "end", 'day=' || day || '/chunk=' || start || '-' || "end" AS path, count(event_id)::BIGINT AS n,
        count_if(event_id % 997 <> 0)::BIGINT AS again FROM k LEFT JOIN ev ON t >= start AND t < "end" GROUP BY ALL),
f AS (SELECT *, CASE WHEN id % 23 = 0 THEN 0 WHEN id % 19 = 0 THEN n - 1 ELSE n END AS lines FROM c WHERE n > 0),
s AS (SELECT id, path, n AS expected_lines, lines,
        CASE WHEN lines = 0 THEN 'missing file' WHEN lines <> n THEN 'wrong lines' WHEN id % 17 = 0 THEN 'wrong content' ELSE 'ok' END AS state FROM f
      UNION ALL SELECT -1, 'day=' || day || '/chunk=0-0', 0, n, 'unknown file' FROM f WHERE id = (SELECT min(id) FROM f))"""


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        ORACLES[name] = sql
        return f

    return add


def damaged(spark, sf_dir: str) -> tuple[DataFrame, DataFrame, str]:
    """(events, chunks as the manifest has them, where a damaged output of them lies)."""
    events, plan = pieces(spark, sf_dir)
    _, lo, _ = view(spark, sf_dir)
    number = lambda start: ((start - lo) / PIECE).cast("long") + 1
    assigned = ch.assign_chunks(events, plan)
    name = F.concat_ws("-", F.col("chunk_start").cast("string"), F.col("chunk_end").cast("string"))
    lines = assigned.select(
        number(F.col("chunk_start")).alias("id"), F.col("chunk_day").alias("day"), name.alias("chunk"), "event_id", encoding.encode_json(assigned, FIELDS).alias("line")
    )
    lines = sinks.keep(lines, "lines")
    planned = sinks.planned_files(lines)
    path = F.concat(F.lit("day="), "day", F.lit("/chunk="), F.concat_ws("-", F.col("start").cast("string"), F.col("end").cast("string")))
    chunks = plan.select("day", "start", "end", path.alias("path")).join(planned, "path", "left")
    n = F.coalesce("lines", F.lit(0))
    chunks = chunks.select(
        number(F.col("start")).alias("id"), F.lit(None).cast("long").alias("parent"), "day", "start", "end", F.lit("done").alias("status"), F.lit("job").alias("mode"),
        n.alias("expected"), n.alias("written"), n.alias("result_count"), F.lit(0).cast("long").alias("multiline"), (F.col("start") * 0).alias("utf8_replacements"),
        F.array().cast("array<struct<type:string,text:string>>").alias("messages"), "path", "hash_sum", "hash_xor",
    )
    last = lines.groupBy("id").agg(F.max("event_id").alias("last"))
    first = lines.agg(F.min("id")).first()[0]
    marked = lines.where("id % 23 <> 0").join(last, "id").withColumn("is_last", F.col("event_id") == F.col("last"))
    left = marked.where(~(F.col("is_last") & (F.col("id") % 19 == 0)))
    changed = left.withColumn("line", F.when(F.col("is_last") & (F.col("id") % 17 == 0), F.concat("line", F.lit(" "))).otherwise(F.col("line")))
    stray = lines.where(F.col("id") == first).select("day", F.lit("0-0").alias("chunk"), "line")
    out = sinks.scratch_dir(spark, "damaged")
    sinks.write_lines(changed.select("day", "chunk", "line").unionByName(stray), out)
    return events, sinks.keep(chunks, "manifest"), out


@query("files_checked", f"WITH {DAMAGED} SELECT path, expected_lines::BIGINT AS expected_lines, lines::BIGINT AS lines, state FROM s")
def files_checked(spark, sf_dir):
    _, chunks, out = damaged(spark, sf_dir)
    return va.files_vs_manifest(members.checked_files(spark, out), chunks.where("written > 0"))


@query("full_validation", f"""WITH {DAMAGED}, p AS (SELECT id FROM c ORDER BY md5('s-' || start || '-' || "end"), start LIMIT 20),
v AS (SELECT 'coverage' AS name, 0 AS bad, 'gaps or overlaps' AS what
  UNION ALL SELECT x, 0, 'chunks' FROM (SELECT unnest(['all-chunks-done', 'written-eq-resultCount', 'no-job-warnings', 'written-eq-expected']) AS x)
  UNION ALL SELECT 'split-parents-eq-children', 0, 'split chunks'
  UNION ALL SELECT 'total-count', count(*), 'differences of the total' FROM (SELECT sum(n) AS n FROM c) WHERE n <> (SELECT count(*) FROM ev)
  UNION ALL SELECT 'files-intact', count(*), 'paths' FROM s WHERE state <> 'ok'
  UNION ALL SELECT 'per-chunk-recount', count(*), 'chunks' FROM c WHERE n <> again
  UNION ALL SELECT 'sample-reextract', count(*), 'chunks' FROM s JOIN p USING (id) WHERE state <> 'ok'
  UNION ALL SELECT 'utf8-replacements', 0, 'replaced sequences')
SELECT name, bad = 0 AS ok, bad::BIGINT AS bad, bad || ' ' || what AS detail FROM v""")
def full_validation(spark, sf_dir):
    """All levels: whole files by hash, an independent recount, and a sample that is extracted from the events again."""
    events, chunks, out = damaged(spark, sf_dir)
    _, lo, hi = view(spark, sf_dir)
    evidence = full_evidence(spark, events, chunks, out)
    total = events.agg(F.count("*").alias("n"))
    return va.validate(chunks, lo, hi, "full", total=total, notes=True, **evidence)


def full_evidence(spark, events: DataFrame, chunks: DataFrame, out: str) -> dict[str, DataFrame]:
    written = sinks.read_extracted(spark, out, damaged=True)
    return {
        "files": members.checked_files(spark, out),
        "recount": ch.chunk_counts(events.where("event_id % 997 <> 0"), chunks.select("day", "start", "end")),
        "sample": va.sample_reextract(chunks, events, written, 20, "s", FIELDS),
    }


@query("chunks_with_issues", f"""WITH {DAMAGED}, p AS (SELECT id FROM c ORDER BY md5('s-' || start || '-' || "end"), start LIMIT 20)
SELECT id::BIGINT AS id, path, 'file' AS issue, CASE WHEN state = 'wrong lines' THEN 'wrong lines ' || lines ELSE state END AS found FROM s WHERE state <> 'ok' AND id > 0
UNION ALL SELECT id, path, 'recount', again::VARCHAR FROM c WHERE n <> again
UNION ALL SELECT id, path, 'reextract', (CASE WHEN lines = 0 THEN expected_lines WHEN lines <> expected_lines THEN 1 ELSE 2 END)::VARCHAR FROM s JOIN p USING (id) WHERE state <> 'ok'""")
def chunks_with_issues(spark, sf_dir):
    """Each chunk that a check of the full level speaks against, and what was found."""
    events, chunks, out = damaged(spark, sf_dir)
    return va.chunk_issues(chunks, **full_evidence(spark, events, chunks, out))


@query("gzip_checked", f"""WITH {DAMAGED}
SELECT path, n::BIGINT AS expected_lines, CASE WHEN id % 5 IN (1, 2) AND (id // 5) % 2 = 0 THEN 'unreadable file' ELSE 'ok' END AS state FROM c WHERE n > 0""")
def gzip_checked(spark, sf_dir):
    """Whole files against ones cut by up to eight bytes, or with one of the last eight changed: all of the latter are found."""
    events, plan = pieces(spark, sf_dir)
    _, lo, _ = view(spark, sf_dir)
    path, out = sinks.scratch_dir(spark, "whole"), sinks.scratch_dir(spark, "altered")
    assigned = ch.assign_chunks(events, plan)
    sinks.write_ndjson(assigned, path, FIELDS)
    number = ((F.col("start") - lo) / PIECE).cast("long") + 1
    picked = F.floor(number / 5) % 2 == 0
    place = F.floor(number / 10) % 8 + 1
    members.copy_altered(spark, path, out, F.when(picked & (number % 5 == 1), place), F.when(picked & (number % 5 == 2), place))
    name = F.concat_ws("-", F.col("chunk_start").cast("string"), F.col("chunk_end").cast("string"))
    lines = assigned.select(F.col("chunk_day").alias("day"), name.alias("chunk"), encoding.encode_json(assigned, FIELDS).alias("line"))
    chunks = sinks.planned_files(lines).withColumns({"written": F.col("lines"), "multiline": F.lit(0), "status": F.lit("done")})
    return va.files_vs_manifest(members.checked_files(spark, out), chunks).select("path", "expected_lines", "state")


@query("compacted_members", f"""WITH {EVENTS}, {PIECES}, k AS (SELECT day, start, count(*) AS n FROM ev JOIN pc ON t >= start AND t < "end" GROUP BY ALL)
SELECT day, sum(n)::BIGINT AS lines, count(*)::BIGINT AS chunks, true AS in_order FROM k GROUP BY day""")
def compacted_members(spark, sf_dir):
    """Days joined from gzip members: their lines, the chunks found in them, and whether lines follow each other by chunk."""
    events, plan = pieces(spark, sf_dir)
    path, out = sinks.scratch_dir(spark, "extract"), sinks.scratch_dir(spark, "days")
    sinks.write_ndjson(ch.assign_chunks(events, plan), path, FIELDS)
    done = ch.chunk_counts(events, plan).select("day", "start", F.lit("done").alias("status"), F.col("n").alias("written"), F.lit(0).alias("multiline"))
    counted = members.compact_members(spark, path, out, done, file_bytes=20_000).where("lines > 0")
    lines = sinks.read_extracted(spark, out)
    # Gzip files are read whole and in order, so positions of lines rise within a file.
    placed = lines.withColumn("at", F.monotonically_increasing_id()).withColumn("piece", F.floor(F.get_json_object("line", "$.t").cast("long") / PIECE))
    blocks = placed.groupBy("day", "file", "piece").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    follows = F.lead("piece").over(Window.partitionBy("day").orderBy("file", "first"))
    runs = blocks.withColumn("rises", F.coalesce(follows >= F.col("piece"), F.lit(True))).withColumn(
        "apart", F.coalesce(F.lead("first").over(Window.partitionBy("day", "file").orderBy("first")) > F.col("last"), F.lit(True))
    )
    found = runs.groupBy("day").agg(F.count_distinct("piece").alias("chunks"), F.bool_and(F.col("rises") & F.col("apart")).alias("in_order"))
    return counted.join(found, "day").select("day", "lines", "chunks", "in_order")


@query("compacted_order", f"""WITH {EVENTS}, {PIECES}, l AS (SELECT day, start, {LINE} AS line FROM ev JOIN pc ON t >= start AND t < "end")
SELECT day, count(*)::BIGINT AS lines, 0::BIGINT AS out_of_order FROM l GROUP BY day""")
def compacted_order(spark, sf_dir):
    """Compacted days: lines, and how many begin before the one above them in the file by chunk."""
    events, plan = pieces(spark, sf_dir)
    path, out = sinks.scratch_dir(spark, "extract"), sinks.scratch_dir(spark, "days")
    sinks.write_ndjson(ch.assign_chunks(events, plan), path, FIELDS)
    counted = ch.chunk_counts(events, plan)
    done = counted.select("day", "start", F.lit("done").alias("status"), F.col("n").alias("written"), F.lit(0).alias("multiline"))
    sinks.compact_days(spark, path, out, done)
    lines = sinks.read_extracted(spark, out)
    # Gzip files are read whole and in order, so positions of lines rise within a file.
    placed = lines.withColumn("at", F.monotonically_increasing_id()).withColumn("piece", F.floor(F.get_json_object("line", "$.t").cast("long") / PIECE))
    blocks = placed.groupBy("day", "file", "piece").agg(F.count("*").alias("n"), F.min("at").alias("first"), F.max("at").alias("last"))
    # A chunk's lines are one run, and runs follow each other by start: so lines before a later chunk's first.
    other = blocks.select("day", "file", F.col("piece").alias("later"), F.col("first").alias("later_first"))
    wrong = blocks.join(other, ["day", "file"]).where("later > piece AND last > later_first").groupBy("day").agg(F.sum("n").alias("wrong"))
    total = lines.groupBy("day").agg(F.count("*").alias("lines"))
    return total.join(wrong, "day", "left").select("day", "lines", F.coalesce("wrong", F.lit(0)).cast("long").alias("out_of_order"))
