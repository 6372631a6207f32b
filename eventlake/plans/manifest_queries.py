"""Queries on a manifest of chunks, with the SQL that checks them.

The manifest is derived from the events: one chunk for each six hours, below one split chunk for each
day. What was written leaves out every 997th event, and statuses, modes and messages follow from the
chunk's number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions import messages as ms
from eventlake.functions import times
from eventlake.operators import chunks as ch
from eventlake.plans import validation as va
from eventlake.plans.event_queries import EVENTS, PIECE, pieces, view
from eventlake.sources.sinks import append_log, keep, read_manifest, scratch_dir, write_manifest

QUERIES: dict = {}
ORACLES: dict = {}

MANIFEST = f"""{EVENTS},
s AS (SELECT lo, (t - lo) // {PIECE} AS k, count(*) AS n, count_if(event_id % 997 <> 0) AS written, sum(CASE WHEN event_id % 997 <> 0 THEN strlen(raw) + 1 ELSE 0 END) AS bytes,
        count_if(event_id % 997 <> 0 AND event_type = 'error') AS multiline FROM ev, r GROUP BY ALL),
a AS (SELECT lo, unnest(range(0, (hi - lo) // {PIECE})) AS k FROM r),
q AS (SELECT a.k + 1 AS id, a.lo + a.k * {PIECE} AS start, a.lo + (a.k + 1) * {PIECE} AS "end", coalesce(n, 0) AS n, coalesce(written, 0) AS written, coalesce(bytes, 0) AS bytes, coalesce(multiline, 0) AS multiline
      FROM a LEFT JOIN s ON a.k = s.k),
m AS (SELECT id::BIGINT AS id, -(1 + (start - (SELECT lo FROM r)) // 86400)::BIGINT AS parent, strftime(make_timestamp(start * 1000000), '%Y-%m-%d') AS day, start::BIGINT AS start, "end"::BIGINT AS "end",
        CASE WHEN id % 13 <> 0 THEN n END::BIGINT AS expected, id % 5 = 0 AS hot, CASE WHEN id % 5 = 0 THEN 'export' ELSE 'job' END AS mode,
        CASE WHEN id % 11 = 0 THEN 'failed' WHEN id % 11 = 1 THEN 'pending' WHEN id % 11 = 2 THEN 'running'
             WHEN id % 13 <> 0 AND written <> n THEN 'mismatch' ELSE 'done' END AS status,
        CASE WHEN id % 5 <> 0 THEN written + CASE WHEN id % 29 = 0 THEN 1 ELSE 0 END END::BIGINT AS result_count,
        written::BIGINT AS written, bytes::BIGINT AS bytes, (id % 10)::BIGINT AS utf8_replacements, multiline::BIGINT AS multiline,
        id % 6 = 0 AS warned, id % 17 = 0 AS errored, (1 + id % 3)::BIGINT AS attempts,
        strftime(make_timestamp(start * 1000000), '%Y-%m-%d') || '/' || start || '-' || "end" || '.jsonl.gz' AS path FROM q),
d AS (SELECT parent AS id, sum(expected + 0)::BIGINT AS expected, sum(written)::BIGINT AS written FROM (SELECT m.parent, q.n AS expected, m.written FROM m JOIN q ON q.id = m.id) GROUP BY parent)"""


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def manifest(spark, sf_dir) -> tuple[DataFrame, int, int]:
    """(leaf chunks with their evidence, range)."""
    events, plan = pieces(spark, sf_dir)
    _, lo, hi = view(spark, sf_dir)
    assigned = ch.assign_chunks(events, plan).withColumn("kept", F.col("event_id") % 997 != 0)
    sums = assigned.groupBy("chunk_start").agg(
        F.count("*").alias("n"),
        F.count_if("kept").alias("written"),
        F.sum(F.when(F.col("kept"), F.octet_length("_raw") + 1).otherwise(0)).cast("long").alias("bytes"),
        F.count_if(F.col("kept") & (F.col("sourcetype") == "error")).alias("multiline"),
    )
    c = plan.select("day", "start", "end").join(sums, F.col("start") == F.col("chunk_start"), "left").fillna(0, ["n", "written", "bytes", "multiline"])
    c = c.withColumn("id", ((F.col("start") - lo) / PIECE).cast("long") + 1)
    known = F.col("id") % 13 != 0
    status = (
        F.when(F.col("id") % 11 == 0, "failed")
        .when(F.col("id") % 11 == 1, "pending")
        .when(F.col("id") % 11 == 2, "running")
        .when(known & (F.col("written") != F.col("n")), "mismatch")
        .otherwise("done")
    )
    note = lambda flag, kind: F.when(flag, F.array(F.struct(F.lit(kind).alias("type"), F.lit("text").alias("text")))).otherwise(F.array().cast(ms.MESSAGES))
    chunks = c.select(
        "id",
        (-1 - ((F.col("start") - lo) / times.SPAN_LADDER[0]).cast("long")).alias("parent"),
        "day",
        "start",
        "end",
        F.when(known, F.col("n")).alias("expected"),
        (F.col("id") % 5 == 0).alias("hot"),
        F.when(F.col("id") % 5 == 0, "export").otherwise("job").alias("mode"),
        status.alias("status"),
        F.when(F.col("id") % 5 != 0, F.col("written") + F.when(F.col("id") % 29 == 0, 1).otherwise(0)).alias("result_count"),
        "written",
        "bytes",
        (F.col("id") % 10).alias("utf8_replacements"),
        "multiline",
        F.concat(note(F.col("id") % 6 == 0, "WARN"), note(F.col("id") % 17 == 0, "ERROR")).alias("messages"),
        (1 + F.col("id") % 3).alias("attempts"),
        times.chunk_path(F.col("day"), F.col("start"), F.col("end")).alias("path"),
        "n",
    )
    return keep(chunks, "manifest"), lo, hi


def with_parents(chunks: DataFrame) -> DataFrame:
    """The leaves and a split chunk above those of each day; one day's parent expects one event too many."""
    days = chunks.groupBy(F.col("parent").alias("id"), "day").agg(
        F.sum("n").alias("expected"), F.min("start").alias("start"), F.max("end").alias("end")
    )
    return chunks.unionByName(days.withColumn("status", F.lit("split")), allowMissingColumns=True)


@query("status_counts", f"WITH {MANIFEST} SELECT status, count(*)::BIGINT AS n FROM (SELECT status FROM m UNION ALL SELECT 'split' FROM d) GROUP BY ALL")
def status_counts(spark, sf_dir):
    return with_parents(manifest(spark, sf_dir)[0]).groupBy("status").agg(F.count("*").alias("n"))


@query("chunk_status_listing", f"""WITH {MANIFEST} SELECT id, day, start, "end", status FROM m WHERE status <> 'done' ORDER BY start""")
def chunk_status_listing(spark, sf_dir):
    rows = va.leaves(with_parents(manifest(spark, sf_dir)[0])).where("status <> 'done'")
    return rows.select("id", "day", "start", "end", "status").orderBy("start")


@query("run_totals", f"WITH {MANIFEST} SELECT sum(written)::BIGINT AS written, sum(bytes)::BIGINT AS bytes, sum(utf8_replacements)::BIGINT AS utf8_replacements, sum(multiline)::BIGINT AS multiline FROM m WHERE status IN ('done', 'mismatch')")
def run_totals(spark, sf_dir):
    return va.run_totals(manifest(spark, sf_dir)[0])


@query("total_check", f"""WITH {MANIFEST} SELECT (SELECT count(*) FROM ev)::BIGINT AS total, sum(CASE WHEN status = 'done' THEN written ELSE 0 END)::BIGINT AS written,
  sum(CASE WHEN status = 'done' THEN utf8_replacements ELSE 0 END)::BIGINT AS utf8, (count_if(status <> 'done') = 0 AND sum(CASE WHEN status = 'done' THEN written ELSE 0 END) = (SELECT count(*) FROM ev)) AS ok FROM m""")
def total_check(spark, sf_dir):
    chunks, _, _ = manifest(spark, sf_dir)
    total = view(spark, sf_dir)[0].agg(F.count("*").alias("total"))
    done = F.col("status") == "done"
    sums = chunks.agg(
        F.sum(F.when(done, F.col("written")).otherwise(0)).alias("written"),
        F.sum(F.when(done, F.col("utf8_replacements")).otherwise(0)).alias("utf8"),
        F.count_if(~done).alias("open"),
    )
    both = total.crossJoin(sums)  # one row each
    return both.select("total", "written", "utf8", ((F.col("open") == 0) & (F.col("written") == F.col("total"))).alias("ok"))


@query("job_evidence", f"WITH {MANIFEST} SELECT id, written, result_count FROM m WHERE status = 'done' AND mode = 'job' AND result_count <> written")
def job_evidence(spark, sf_dir):
    rows = va.done(manifest(spark, sf_dir)[0]).where("mode = 'job' AND result_count <> written")
    return rows.select("id", "written", "result_count")


@query("message_check", f"""WITH {MANIFEST} SELECT count_if(errored)::BIGINT AS errored, count_if(warned)::BIGINT AS warned, count_if(errored) = 0 AND count_if(warned) = 0 AS ok_strict, count_if(errored) = 0 AS ok_lenient
FROM m WHERE status = 'done'""")
def message_check(spark, sf_dir):
    done = va.done(manifest(spark, sf_dir)[0])
    found = done.agg(
        F.count_if(ms.has_level(F.col("messages"), "ERROR", "FATAL")).alias("errored"), F.count_if(ms.has_level(F.col("messages"), "WARN")).alias("warned")
    )
    return found.withColumn("ok_strict", (F.col("errored") == 0) & (F.col("warned") == 0)).withColumn("ok_lenient", F.col("errored") == 0)


@query("split_rollup", f"WITH {MANIFEST} SELECT id, expected, written AS children, expected = written AS ok FROM d")
def split_rollup(spark, sf_dir):
    return va.split_rollup(with_parents(manifest(spark, sf_dir)[0]))


@query("coverage_gaps", f"""WITH {MANIFEST}, l AS (SELECT start, CASE WHEN id % 37 = 0 THEN "end" + 60 ELSE "end" END AS "end" FROM m WHERE id % 41 <> 5),
o AS (SELECT *, lead(start) OVER w AS nx, lead("end") OVER w AS ne, row_number() OVER w AS i FROM l WINDOW w AS (ORDER BY start, "end")),
g AS (SELECT 'first' AS kind, start, lo AS "end" FROM o, r WHERE i = 1 AND start <> lo
  UNION ALL SELECT 'last', o."end", hi FROM o, r WHERE nx IS NULL AND o."end" <> hi
  UNION ALL SELECT 'gap', "end", nx FROM o WHERE "end" < nx
  UNION ALL SELECT 'overlap', nx, least("end", ne) FROM o WHERE "end" > nx)
SELECT kind, start::BIGINT AS start, "end"::BIGINT AS "end" FROM g ORDER BY 2, 3, 1 LIMIT 20""")
def coverage_gaps(spark, sf_dir):
    """The manifest with some chunks missing and some too long."""
    chunks, lo, hi = manifest(spark, sf_dir)
    broken = chunks.where("id % 41 <> 5").withColumn("end", F.col("end") + F.when(F.col("id") % 37 == 0, 60).otherwise(0))
    return va.coverage_gaps(va.leaves(broken), lo, hi)


@query("resume_remaining", f"""WITH {MANIFEST} SELECT id, start, "end", status FROM m WHERE status <> 'done'""")
def resume_remaining(spark, sf_dir):
    chunks = with_parents(manifest(spark, sf_dir)[0])
    return ch.remaining_chunks(chunks, va.done(chunks)).select("id", "start", "end", "status")


@query("pending_order", f"""WITH {MANIFEST} SELECT id, start FROM m, r WHERE status = 'pending' AND (id % 4 = 0 OR start <= hi - 86400) ORDER BY start""")
def pending_order(spark, sf_dir):
    chunks, _, hi = manifest(spark, sf_dir)
    waiting = chunks.withColumn("not_before", F.when(F.col("id") % 4 != 0, F.col("start")))
    return ch.pending_order(waiting, F.lit(hi - 86400)).select("id", "start")


@query("chunk_paths", f"WITH {MANIFEST} SELECT id, path, replace(path, '.jsonl.gz', '.raw.gz') AS raw_path FROM m")
def chunk_paths(spark, sf_dir):
    chunks = manifest(spark, sf_dir)[0]
    return chunks.select("id", "path", times.chunk_path(F.col("day"), F.col("start"), F.col("end"), "raw").alias("raw_path"))


@query("chunk_modes", f"WITH {MANIFEST} SELECT id, CASE WHEN hot AND coalesce(expected, 0) > 80 THEN 'export' ELSE 'job' END AS mode FROM m")
def chunk_modes(spark, sf_dir):
    chunks = manifest(spark, sf_dir)[0]
    return chunks.select("id", ch.chunk_mode("job", F.col("hot"), F.col("expected"), 80).alias("mode"))


@query("chunk_outcomes", f"""WITH {MANIFEST} SELECT id, CASE WHEN written > 100 THEN 'overflow' WHEN errored OR warned THEN CASE WHEN attempts >= 2 THEN 'failed' ELSE 'retry' END
  WHEN expected IS NOT NULL AND expected <> written THEN CASE WHEN attempts >= 2 THEN 'mismatch' ELSE 'retry' END ELSE 'done' END AS outcome FROM m""")
def chunk_outcomes(spark, sf_dir):
    chunks = manifest(spark, sf_dir)[0]
    troubles = ms.problems(F.lit(False), F.lit(False), F.col("messages"), strict=True)
    outcome = ch.chunk_outcome(F.col("written") > 100, troubles, F.col("expected"), F.col("written"), F.col("attempts"), 2)
    return chunks.select("id", outcome.alias("outcome"))


@query("files_intact", f"""WITH {MANIFEST}, f AS (SELECT path, written + CASE WHEN id % 19 = 0 THEN 1 ELSE 0 END AS lines FROM m WHERE id % 23 <> 0),
p AS (SELECT path, written + multiline AS expected_lines FROM m WHERE status = 'done')
SELECT coalesce(p.path, f.path) AS path, coalesce(expected_lines, 0)::BIGINT AS expected_lines, coalesce(lines, 0)::BIGINT AS lines,
  CASE WHEN f.path IS NULL THEN 'missing file' WHEN p.path IS NULL THEN 'unknown file' WHEN lines <> expected_lines THEN 'wrong lines' ELSE 'ok' END AS state FROM p FULL JOIN f ON p.path = f.path""")
def files_intact(spark, sf_dir):
    chunks = manifest(spark, sf_dir)[0]
    files = chunks.where("id % 23 <> 0").select("path", (F.col("written") + F.when(F.col("id") % 19 == 0, 1).otherwise(0)).alias("lines"))
    return va.files_vs_manifest(files, chunks)


@query("validation_checks", f"""WITH {MANIFEST}, f AS (SELECT * FROM m WHERE status = 'done')
SELECT 'coverage' AS name, true AS ok, 0::BIGINT AS bad
UNION ALL SELECT 'all-chunks-done', count(*) = 0, count(*)::BIGINT FROM m WHERE status <> 'done'
UNION ALL SELECT 'written-eq-resultCount', count(*) = 0, count(*)::BIGINT FROM f WHERE mode = 'job' AND written <> result_count
UNION ALL SELECT 'no-job-warnings', count(*) = 0, count(*)::BIGINT FROM f WHERE warned OR errored
UNION ALL SELECT 'written-eq-expected', count(*) = 0, count(*)::BIGINT FROM f WHERE written <> expected
UNION ALL SELECT 'split-parents-eq-children', count(*) = 0, count(*)::BIGINT FROM d WHERE expected <> written
UNION ALL SELECT 'total-count', count(*) = 0, count(*)::BIGINT FROM (SELECT sum(written) AS w FROM f) WHERE w <> (SELECT count(*) FROM ev) OR (SELECT count(*) FROM m WHERE status <> 'done') > 0""")
def validation_checks(spark, sf_dir):
    chunks, lo, hi = manifest(spark, sf_dir)
    total = view(spark, sf_dir)[0].agg(F.count("*").alias("n"))
    return va.validate(with_parents(chunks), lo, hi, "total", total=total)


@query("run_verdict", f"""WITH {MANIFEST} SELECT 'as written' AS run, count_if(status <> 'done') = 0 AND count_if(warned OR errored) = 0 AS ok FROM m
UNION ALL SELECT 'repaired', (SELECT count(*) FROM ev) = sum(n) FROM q""")
def run_verdict(spark, sf_dir):
    """The verdict on the manifest, and on one whose chunks were all extracted again without trouble."""
    chunks, lo, hi = manifest(spark, sf_dir)
    total = view(spark, sf_dir)[0].agg(F.count("*").alias("n"))
    repaired = chunks.withColumns({
        "status": F.lit("done"), "written": F.col("n"), "result_count": F.col("n"), "expected": F.col("n"), "messages": F.array().cast(ms.MESSAGES),
    })
    verdicts = [
        va.run_verdict(c, va.validate(c, lo, hi, "total", total=total)).withColumn("run", F.lit(name)) for name, c in (("as written", chunks), ("repaired", repaired))
    ]
    return verdicts[0].unionByName(verdicts[1]).select("run", "ok")


@query("manifest_round_trip", f"""WITH {MANIFEST} SELECT id, start, "end", status, attempts, 'chunk ' || id AS detail FROM m""")
def manifest_round_trip(spark, sf_dir):
    """Run, chunks and log are written together and read back; the log has a row for each chunk."""
    chunks, lo, hi = manifest(spark, sf_dir)
    run = chunks.agg(F.count("*").alias("chunks")).select(F.lit("run").alias("id"), F.lit("hash").alias("search_hash"), "chunks")
    log = chunks.select(F.col("start").cast("double").alias("ts"), F.col("id").alias("chunk"), F.col("status").alias("kind"), F.concat(F.lit("chunk "), F.col("id").cast("string")).alias("detail"))
    path = scratch_dir(spark, "manifest")
    write_manifest(path, run, chunks, log.limit(0))
    append_log(log, path)
    _, again, entries = read_manifest(spark, path)
    return again.join(entries, again["id"] == entries["chunk"]).select("id", "start", "end", "status", "attempts", "detail")


@query("expected_exports", f"""WITH {MANIFEST} SELECT m.id, CASE WHEN m.mode = 'export' AND m.expected IS NULL THEN q.n ELSE m.expected END::BIGINT AS expected FROM m JOIN q ON m.id = q.id""")
def expected_exports(spark, sf_dir):
    """Export chunks without an expected count are counted; other unknown counts stay unknown."""
    chunks = manifest(spark, sf_dir)[0]
    return ch.expect_exports(chunks, view(spark, sf_dir)[0]).select("id", "expected")


@query("report_round_trip", f"""WITH {MANIFEST}, f AS (SELECT * FROM m WHERE status = 'done')
SELECT id, path, 'status' AS issue, status AS found FROM m WHERE status <> 'done'
UNION ALL SELECT id, path, 'resultCount', result_count::VARCHAR FROM f WHERE mode = 'job' AND written <> result_count
UNION ALL SELECT id, path, 'expected', expected::VARCHAR FROM f WHERE written <> expected
UNION ALL SELECT NULL, NULL, 'all-chunks-done', count(*)::VARCHAR FROM m WHERE status <> 'done'
UNION ALL SELECT NULL, NULL, 'no-job-warnings', count(*)::VARCHAR FROM f WHERE warned OR errored
UNION ALL SELECT NULL, NULL, 'written-eq-resultCount', count(*)::VARCHAR FROM f WHERE mode = 'job' AND written <> result_count
UNION ALL SELECT NULL, NULL, 'coverage', '0'""")
def report_round_trip(spark, sf_dir):
    """A report as it is read back: the chunks with issues, and the checks of the job level with what they counted."""
    chunks, lo, hi = manifest(spark, sf_dir)
    path = scratch_dir(spark, "report")
    va.write_report(va.validate(chunks, lo, hi, "job"), va.chunk_issues(chunks), path)
    issues = spark.read.schema(va.ISSUE).json(f"{path}/chunks_with_issues")
    checks = spark.read.json(f"{path}/checks")
    none = F.lit(None)
    rows = checks.select(none.cast("long").alias("id"), none.cast("string").alias("path"), F.col("name").alias("issue"), F.col("bad").cast("string").alias("found"))
    return issues.unionByName(rows)
