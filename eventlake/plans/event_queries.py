"""Queries on events: extraction, histograms, plans, chunks and files, with the SQL that checks them.

All of them work on the range of whole days that holds the table's events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions import encoding, times
from eventlake.operators import chunks as ch
from eventlake.operators import planning
from eventlake.sources import events as ev
from eventlake.sources import sinks

SPAN, TARGET, CAP, PAGE, PIECE = 3600, 20, 40, 25, 21600
#: Index times from this offset behind the range's start on are not in the snapshot.
PIN_DAYS, NEW_PIN_DAYS = 14, 20

QUERIES: dict = {}
ORACLES: dict = {}

EVENTS = """ev AS (
  SELECT event_id, floor(epoch_us(ts) / 1e6)::BIGINT AS t, floor(epoch_us(ts) / 1e6)::BIGINT + (event_id * 7919) % 3600 AS indextime,
         event_id::VARCHAR || ' ' || event_type || ' ' || props AS raw, event_type, user_id, event_id % 50 AS cd FROM events),
r AS (SELECT min(t) // 86400 * 86400 AS lo, (max(t) // 86400 + 1) * 86400 AS hi FROM ev)"""
DAYS = "days AS (SELECT unnest(range(lo, hi, 86400)) AS ds FROM r)"
PIECES = """pc AS (SELECT strftime(make_timestamp(s * 1000000), '%Y-%m-%d') AS day, s AS start, s + 21600 AS "end"
  FROM (SELECT unnest(range(lo, hi, 21600)) AS s FROM r))"""


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def view(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int, int]:
    events = ev.events_view(spark, sf_dir)
    return events, *ev.whole_days(events)


def ranges(spark: SparkSession, lo: int, hi: int) -> DataFrame:
    return spark.range(1).select(F.lit(lo).cast("long").alias("start"), F.lit(hi).cast("long").alias("end"))


def pieces(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(events, fixed chunks of six hours)."""
    events, lo, hi = view(spark, sf_dir)
    return events, planning.fixed_chunks(ranges(spark, lo, hi), PIECE)


@query("extract_window", f"WITH {EVENTS} SELECT event_id, t, raw AS _raw, event_type AS sourcetype FROM ev, r WHERE t >= lo AND t < hi - 86400 AND indextime < lo + {PIN_DAYS} * 86400")
def extract_window(spark, sf_dir):
    events, lo, hi = view(spark, sf_dir)
    return ev.extract_events(events, lo, hi - ev.DAY, lo + PIN_DAYS * ev.DAY, ["event_id", "t", "_raw", "sourcetype", "no_such_field"])


@query("pinned_count", f"WITH {EVENTS} SELECT count(*)::BIGINT AS n FROM ev, r WHERE indextime < lo + {PIN_DAYS} * 86400")
def pinned_count(spark, sf_dir):
    events, lo, _ = view(spark, sf_dir)
    return ev.pin_snapshot(events, lo + PIN_DAYS * ev.DAY).agg(F.count("*").alias("n"))


@query("delta_late_events", f"WITH {EVENTS} SELECT event_id, t, indextime AS _indextime FROM ev, r WHERE t >= lo AND t < hi AND indextime >= lo + {PIN_DAYS} * 86400 AND indextime < lo + {NEW_PIN_DAYS} * 86400")
def delta_late_events(spark, sf_dir):
    events, lo, hi = view(spark, sf_dir)
    return ev.delta_window(events, lo, hi, lo + PIN_DAYS * ev.DAY, lo + NEW_PIN_DAYS * ev.DAY).select("event_id", "t", "_indextime")


@query("histogram_hourly", f"""WITH {EVENTS} SELECT greatest(t // 3600 * 3600, lo)::BIGINT AS start, least(t // 3600 * 3600 + 3600, hi)::BIGINT AS "end", count(*)::BIGINT AS count FROM ev, r GROUP BY ALL""")
def histogram_hourly(spark, sf_dir):
    events, lo, hi = view(spark, sf_dir)
    return planning.histogram(events, SPAN, lo, hi)


@query("day_counts", f"""WITH {EVENTS} SELECT strftime(timezone('America/New_York', to_timestamp(t)), '%Y-%m-%d') AS day, count(*)::BIGINT AS n FROM ev GROUP BY ALL""")
def day_counts(spark, sf_dir):
    events, _, _ = view(spark, sf_dir)
    return events.groupBy(times.day_of(F.col("t"), "America/New_York").alias("day")).agg(F.count("*").alias("n"))


@query("day_bounds", f"""WITH {EVENTS}, {DAYS} SELECT strftime(make_timestamp(ds * 1000000), '%Y-%m-%d') AS day, greatest(ds, lo + 7200)::BIGINT AS start, least(ds + 86400, hi - 3600)::BIGINT AS "end" FROM days, r""")
def day_bounds(spark, sf_dir):
    _, lo, hi = view(spark, sf_dir)
    return times.day_bounds(ranges(spark, lo + 7200, hi - 3600))


@query("day_bounds_dst", f"""WITH {EVENTS}, k AS (SELECT unnest(generate_series(timezone('America/New_York', to_timestamp(lo))::DATE, timezone('America/New_York', to_timestamp(hi + 180 * 86400 - 1))::DATE, INTERVAL 1 DAY)) AS d, lo, hi + 180 * 86400 AS hi FROM r)
SELECT strftime(d, '%Y-%m-%d') AS day, greatest(epoch(timezone('America/New_York', d::TIMESTAMP))::BIGINT, lo) AS start, least(epoch(timezone('America/New_York', (d + INTERVAL 1 DAY)::TIMESTAMP))::BIGINT, hi) AS "end" FROM k""")
def day_bounds_dst(spark, sf_dir):
    """Local days from the first event on, past a change of clocks: one of them has 23 hours."""
    _, lo, hi = view(spark, sf_dir)
    return times.day_bounds(ranges(spark, lo, hi + 180 * ev.DAY), "America/New_York")


@query("formatted_times", f"""WITH {EVENTS} SELECT event_id, strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%S') || '.000+00:00' AS _time FROM ev""")
def formatted_times(spark, sf_dir):
    return ev.events_view(spark, sf_dir).select("event_id", times.format_time(F.col("t")).alias("_time"))


def _bins_sql(target: int = TARGET) -> str:
    """Bins by plain recursion down the ladder 3600, 600, 60, 10, 1."""
    spans, sql = (3600, 600, 60, 10, 1), []
    sql.append("b0 AS (SELECT greatest(t // 3600 * 3600, lo) AS s, least(t // 3600 * 3600 + 3600, hi) AS e, count(*) AS c FROM ev, r GROUP BY ALL)")
    for i, span in enumerate(spans[1:], 1):
        sql.append(
            f"b{i} AS (SELECT greatest(t // {span} * {span}, s) AS s, least(t // {span} * {span} + {span}, e) AS e, count(*) AS c "
            f"FROM b{i - 1} JOIN ev ON t >= s AND t < e WHERE c > {target} AND e - s > 1 GROUP BY ALL)"
        )
    parts = [f"SELECT s, e, c FROM b{i} WHERE c <= {target} OR e - s <= 1" + (" OR true" if i == 4 else "") for i in range(5)]
    return ", ".join(sql) + ", bins AS (" + " UNION ALL ".join(parts) + ")"


BINS = _bins_sql()
PACKED = f"""{BINS}, {DAYS},
nb AS (SELECT s // 86400 * 86400 AS ds, s, e, c, row_number() OVER (PARTITION BY s // 86400 ORDER BY s) AS i FROM bins),
st AS (
  SELECT ds, 0::BIGINT AS i, ds AS cur, 0::BIGINT AS cum, NULL::BIGINT AS cs, NULL::BIGINT AS ce, NULL::BIGINT AS cc,
         NULL::BIGINT AS hs, NULL::BIGINT AS he, NULL::BIGINT AS hc FROM days
  UNION ALL
  SELECT st.ds, nb.i,
         CASE WHEN c > {TARGET} THEN e WHEN cum > 0 AND cum + c > {TARGET} THEN s ELSE cur END,
         CASE WHEN c > {TARGET} THEN 0 WHEN cum > 0 AND cum + c > {TARGET} THEN c ELSE cum + c END,
         CASE WHEN (c > {TARGET} AND s > cur) OR (c <= {TARGET} AND cum > 0 AND cum + c > {TARGET}) THEN cur END, s, cum,
         CASE WHEN c > {TARGET} THEN s END, e, c
  FROM st JOIN nb ON nb.ds = st.ds AND nb.i = st.i + 1),
pk AS (
  SELECT ds, cs AS start, ce AS "end", cc AS expected, false AS hot FROM st WHERE cs IS NOT NULL
  UNION ALL SELECT ds, hs, he, hc, true FROM st WHERE hs IS NOT NULL
  UNION ALL SELECT ds, cur, ds + 86400, cum, false FROM (SELECT *, row_number() OVER (PARTITION BY ds ORDER BY i DESC) AS z FROM st) WHERE z = 1 AND cur < ds + 86400),
pack AS (SELECT strftime(make_timestamp(ds * 1000000), '%Y-%m-%d') AS day, start::BIGINT AS start, "end"::BIGINT AS "end", expected::BIGINT AS expected, hot FROM pk)"""


def packed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events, lo, hi = view(spark, sf_dir)
    return events, sinks.keep(planning.plan(events, lo, hi, SPAN, TARGET), "plan")


@query("refined_bins", f"""WITH {EVENTS}, {BINS} SELECT s::BIGINT AS start, e::BIGINT AS "end", c::BIGINT AS count FROM bins""")
def refined_bins(spark, sf_dir):
    events, lo, hi = view(spark, sf_dir)
    return planning.refine(events, lo, hi, SPAN, TARGET)


@query("pack_chunks", f"WITH RECURSIVE {EVENTS}, {PACKED} SELECT * FROM pack")
def pack_chunks(spark, sf_dir):
    return packed(spark, sf_dir)[1]


@query("plan_summary", f"WITH RECURSIVE {EVENTS}, {PACKED} SELECT count(*)::BIGINT AS chunks, sum(expected)::BIGINT AS expected, count(expected)::BIGINT AS known, count_if(hot)::BIGINT AS hot FROM pack")
def plan_summary(spark, sf_dir):
    return planning.plan_summary(packed(spark, sf_dir)[1])


@query("fixed_chunks", f"""WITH {EVENTS}, {PIECES} SELECT day, start::BIGINT AS start, "end"::BIGINT AS "end", NULL::BIGINT AS expected, false AS hot FROM pc""")
def fixed_chunks(spark, sf_dir):
    return pieces(spark, sf_dir)[1]


@query("coarse_histogram", """WITH l AS (SELECT epoch(l_shipdate)::BIGINT AS t FROM lineitem), r AS (SELECT min(t) // 86400 * 86400 AS lo, (max(t) // 86400 + 1) * 86400 AS hi FROM l),
s AS (SELECT CASE WHEN (hi - lo) // 3600 <= 40000 THEN 3600 ELSE 86400 END AS span FROM r)
SELECT greatest(t // span * span, lo)::BIGINT AS start, least(t // span * span + span, hi)::BIGINT AS "end", count(*)::BIGINT AS count FROM l, r, s GROUP BY ALL""")
def coarse_histogram(spark, sf_dir):
    rows = ev.read_table(spark, sf_dir, "lineitem").select(times.epoch(F.col("l_shipdate")).alias("t"))
    lo, hi = ev.whole_days(rows)
    return planning.histogram(rows, times.initial_span(lo, hi, SPAN), lo, hi)


@query("chunk_assignment", f"""WITH RECURSIVE {EVENTS}, {PACKED} SELECT event_id, start AS chunk_start, "end" AS chunk_end FROM ev JOIN pack ON t >= start AND t < "end" """)
def chunk_assignment(spark, sf_dir):
    events, plan = packed(spark, sf_dir)
    return ch.assign_chunks(events, plan).select("event_id", "chunk_start", "chunk_end")


@query("chunk_counts", f"""WITH {EVENTS}, {PIECES} SELECT day, start::BIGINT AS start, "end"::BIGINT AS "end", count(event_id)::BIGINT AS n FROM pc LEFT JOIN ev ON t >= start AND t < "end" GROUP BY ALL""")
def chunk_counts(spark, sf_dir):
    events, plan = pieces(spark, sf_dir)
    return ch.chunk_counts(events, plan).select("day", "start", "end", "n")


@query("written_vs_expected", f"""WITH RECURSIVE {EVENTS}, {PACKED}, w AS (SELECT start AS s, count(*) AS n FROM ev JOIN pack ON t >= start AND t < "end" WHERE event_id % 997 <> 0 GROUP BY ALL)
SELECT start, "end", day, expected, hot, coalesce(n, 0)::BIGINT AS written, expected = coalesce(n, 0) AS matches FROM pack LEFT JOIN w ON s = start""")
def written_vs_expected(spark, sf_dir):
    events, plan = packed(spark, sf_dir)
    written = ch.chunk_counts(events.where("event_id % 997 <> 0"), plan)
    return ch.plan_vs_written(plan, written)


@query("per_chunk_recount", f"""WITH {EVENTS}, {PIECES}, c AS (SELECT start, "end", count(event_id) AS n, count_if(event_id % 997 <> 0) AS written FROM pc LEFT JOIN ev ON t >= start AND t < "end" GROUP BY ALL)
SELECT start::BIGINT AS start, "end"::BIGINT AS "end", written::BIGINT AS written, n::BIGINT AS recount FROM c WHERE written <> n""")
def per_chunk_recount(spark, sf_dir):
    events, plan = pieces(spark, sf_dir)
    written = ch.chunk_counts(events.where("event_id % 997 <> 0"), plan).select("start", "end", F.col("n").alias("written"))
    again = ch.chunk_counts(events, plan).select("start", "end", F.col("n").alias("recount"))
    return written.join(again, ["start", "end"]).where("written <> recount")


@query("overflow_chunks", f"""WITH {EVENTS}, {PIECES} SELECT day, start::BIGINT AS start, "end"::BIGINT AS "end", count(event_id)::BIGINT AS n FROM pc JOIN ev ON t >= start AND t < "end" GROUP BY ALL HAVING count(*) > {CAP}""")
def overflow_chunks(spark, sf_dir):
    events, plan = pieces(spark, sf_dir)
    return ch.overflow_chunks(ch.chunk_counts(events, plan), CAP).select("day", "start", "end", "n")


@query("bisect_overflow", f"""WITH RECURSIVE {EVENTS}, {PIECES}, sec AS (SELECT t, count(*) AS n FROM ev GROUP BY t),
tree AS (
  SELECT day, start AS s, "end" AS e, NULL::VARCHAR AS parent, (SELECT coalesce(sum(n), 0) FROM sec WHERE t >= start AND t < "end") AS n FROM pc
  UNION ALL
  SELECT day, h.s, h.e, p.s || '-' || p.e, (SELECT coalesce(sum(sec.n), 0) FROM sec WHERE sec.t >= h.s AND sec.t < h.e)
  FROM (SELECT day, s, e, n, unnest([{{'s': s, 'e': s + (e - s) // 2}}, {{'s': s + (e - s) // 2, 'e': e}}]) AS h FROM tree WHERE n > {CAP} AND e - s >= 2) AS p)
SELECT day, s::BIGINT AS start, e::BIGINT AS "end", parent, n::BIGINT AS n, CASE WHEN n > {CAP} AND e - s >= 2 THEN 'split' ELSE 'done' END AS status,
       CASE WHEN n > {CAP} AND e - s < 2 THEN 'export' ELSE 'job' END AS mode, n > {CAP} AND e - s < 2 AS hot FROM tree""")
def bisect_overflow(spark, sf_dir):
    events, plan = pieces(spark, sf_dir)
    return ch.bisect_overflow(plan, events, CAP)


@query("page_counts", f"""WITH {EVENTS}, {PIECES} SELECT start::BIGINT AS chunk_start, (rn // {PAGE})::BIGINT AS page, count(*)::BIGINT AS n FROM
(SELECT start, row_number() OVER (PARTITION BY start ORDER BY t, event_id) - 1 AS rn FROM ev JOIN pc ON t >= start AND t < "end") GROUP BY ALL""")
def page_counts(spark, sf_dir):
    events, plan = pieces(spark, sf_dir)
    return ch.paginate(ch.assign_chunks(events, plan), PAGE, ["t", "event_id"]).groupBy("chunk_start", "page").agg(F.count("*").alias("n"))


@query("capped_chunks", f"""WITH {EVENTS}, {PIECES} SELECT event_id, start::BIGINT AS chunk_start, n > {CAP} AS truncated FROM
(SELECT event_id, start, row_number() OVER (PARTITION BY start ORDER BY t DESC, event_id) AS rn, count(*) OVER (PARTITION BY start) AS n FROM ev JOIN pc ON t >= start AND t < "end") WHERE rn <= {CAP}""")
def capped_chunks(spark, sf_dir):
    events, plan = pieces(spark, sf_dir)
    return ch.capped_result(ch.assign_chunks(events, plan), CAP).select("event_id", "chunk_start", "truncated")


@query("partition_exactness", f"""WITH {EVENTS} SELECT count(*)::BIGINT AS whole, count(*)::BIGINT AS chunked, 0::BIGINT AS differences FROM ev""")
def partition_exactness(spark, sf_dir):
    """A row-local transform over all chunks gives the rows of one run over the whole range."""
    events, plan = packed(spark, sf_dir)
    transform = lambda df: df.select("event_id", F.upper("sourcetype").alias("kind"))
    whole = transform(events)
    chunked = transform(ch.assign_chunks(events, plan))
    tagged = whole.withColumn("side", F.lit(1)).unionByName(chunked.withColumn("side", F.lit(-1)))
    # Equal multisets: the signs of equal rows cancel out.
    rows = tagged.groupBy("event_id", "kind").agg(F.count_if(F.col("side") > 0).alias("a"), F.count_if(F.col("side") < 0).alias("b"))
    return rows.agg(F.sum("a").alias("whole"), F.sum("b").alias("chunked"), F.count_if(F.col("a") != F.col("b")).alias("differences"))


@query("key_uniqueness", f"WITH {EVENTS} SELECT count(*)::BIGINT AS rows, count(DISTINCT (user_id, cd))::BIGINT AS keys FROM ev")
def key_uniqueness(spark, sf_dir):
    return ch.key_uniqueness(ev.events_view(spark, sf_dir), ["_bkt", "_cd"])


@query("scan_vs_result", "SELECT count(*)::BIGINT AS scanned, sum(len(regexp_extract_all(text, '[^ \\t-\\r]+')))::BIGINT AS results FROM documents")
def scan_vs_result(spark, sf_dir):
    docs = ev.read_table(spark, sf_dir, "documents")
    made = F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    return docs.agg(F.count("*").alias("scanned"), F.sum(made.cast("long")).alias("results"))


@query("latest_transition", f"""WITH {EVENTS}, {PIECES} SELECT start::BIGINT AS chunk, arg_max(event_type, event_id) AS kind, max(t)::BIGINT AS ts FROM ev JOIN pc ON t >= start AND t < "end" GROUP BY ALL""")
def latest_transition(spark, sf_dir):
    """Events stand for the log of their chunk; the latest one is its state."""
    events, plan = pieces(spark, sf_dir)
    log = ch.assign_chunks(events, plan)
    return log.groupBy(F.col("chunk_start").alias("chunk")).agg(F.max_by("sourcetype", F.struct("t", "event_id")).alias("kind"), F.max("t").alias("ts"))


@query("recent_log", f"WITH {EVENTS} SELECT t AS ts, event_id, event_type AS kind, raw[:4000] AS detail FROM ev ORDER BY t DESC, event_id DESC LIMIT 200")
def recent_log(spark, sf_dir):
    events = ev.events_view(spark, sf_dir)
    log = events.select(F.col("t").alias("ts"), "event_id", F.col("sourcetype").alias("kind"), F.substring("_raw", 1, 4000).alias("detail"))
    return log.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(200)


# -- lines and files ----------------------------------------------------------------------------

FIELDS = ["t", "event_id", "_raw", "host", "missing"]
LINE = """'{"t":' || t || ',"event_id":' || event_id || ',"_raw":' || to_json(raw) || ',"host":"u' || user_id || '"}'"""


@query("ndjson_lines", f"WITH {EVENTS} SELECT event_id, {LINE} AS line FROM ev")
def ndjson_lines(spark, sf_dir):
    events = ev.events_view(spark, sf_dir)
    return events.select("event_id", encoding.encode_json(events, FIELDS).alias("line"))


@query("raw_lines", "SELECT doc_id, coalesce(text, '') AS line FROM documents")
def raw_lines(spark, sf_dir):
    return ev.read_table(spark, sf_dir, "documents").select("doc_id", encoding.encode_raw(F.col("text")).alias("line"))


@query("multiline_counts", "SELECT doc_id, coalesce(length(text) - length(replace(text, chr(10), '')), 0)::BIGINT AS extra FROM documents")
def multiline_counts(spark, sf_dir):
    return ev.read_table(spark, sf_dir, "documents").select("doc_id", encoding.extra_lines(F.col("text")).alias("extra"))


@query("content_digest", f"""WITH {EVENTS}, {PIECES} SELECT start::BIGINT AS chunk_start, count(*)::BIGINT AS rows, sha256(string_agg(line || chr(10), '' ORDER BY line || chr(10))) AS digest
FROM (SELECT start, {LINE} AS line FROM ev JOIN pc ON t >= start AND t < "end") GROUP BY ALL""")
def content_digest(spark, sf_dir):
    events, plan = pieces(spark, sf_dir)
    assigned = ch.assign_chunks(events, plan)
    return encoding.sorted_digest(assigned.select("chunk_start", encoding.encode_json(assigned, FIELDS).alias("line")), ["chunk_start"])


@query("planned_digest", f"""WITH RECURSIVE {EVENTS}, {PACKED} SELECT start AS chunk_start, count(*)::BIGINT AS rows, sha256(string_agg(line || chr(10), '' ORDER BY line || chr(10))) AS digest
FROM (SELECT start, {LINE} AS line FROM ev JOIN pack ON t >= start AND t < "end") GROUP BY ALL""")
def planned_digest(spark, sf_dir):
    """Digests of the chunks of a plan, whose rows are bounded."""
    events, plan = packed(spark, sf_dir)
    assigned = ch.assign_chunks(events, plan)
    return encoding.sorted_digest(assigned.select("chunk_start", encoding.encode_json(assigned, FIELDS).alias("line")), ["chunk_start"])


def _written(spark, sf_dir) -> tuple[DataFrame, DataFrame, str]:
    events, plan = pieces(spark, sf_dir)
    path = sinks.scratch_dir(spark, "extract")
    assigned = ch.assign_chunks(events, plan)
    sinks.write_ndjson(assigned, path, FIELDS)
    return events, plan, path


@query("file_stats", f"""WITH {EVENTS}, {PIECES} SELECT day, start || '-' || "end" AS chunk, count(*)::BIGINT AS lines, sum(strlen({LINE}) + 1)::BIGINT AS bytes FROM ev JOIN pc ON t >= start AND t < "end" GROUP BY ALL""")
def file_stats(spark, sf_dir):
    _, _, path = _written(spark, sf_dir)
    return sinks.file_stats(sinks.read_extracted(spark, path), "day", "chunk")


@query("compact_day_counts", f"""WITH {EVENTS} SELECT strftime(make_timestamp(t * 1000000), '%Y-%m-%d') AS day, count(*)::BIGINT AS lines FROM ev GROUP BY ALL""")
def compact_day_counts(spark, sf_dir):
    events, plan, path = _written(spark, sf_dir)
    done = ch.chunk_counts(events, plan).select("day", "start", F.lit("done").alias("status"), F.col("n").alias("written"), F.lit(0).alias("multiline"))
    return sinks.compact_days(spark, path, sinks.scratch_dir(spark, "days"), done).where("lines > 0")


@query("head_n", f"""WITH {EVENTS}, {PIECES} SELECT start || '-' || "end" AS chunk, {LINE} AS line FROM ev JOIN pc ON t >= start AND t < "end" ORDER BY start, line LIMIT 100""")
def head_n(spark, sf_dir):
    _, _, path = _written(spark, sf_dir)
    return sinks.head(sinks.read_extracted(spark, path).select("chunk", "line"), 100)


@query("export_rows", f"WITH {EVENTS} SELECT event_id::VARCHAR AS id, raw FROM ev WHERE event_id % 10 <> 3")
def export_rows(spark, sf_dir):
    envelopes = ev.read_export_stream(spark, _export_files(spark, sf_dir))
    return ev.export_rows(envelopes).select(F.col("result")["id"].alias("id"), F.col("result")["raw"].alias("raw"))


def _export_files(spark, sf_dir) -> str:
    """Events as export envelopes, one folder for each type: tenths are previews, errors lack their last row."""
    events = ev.events_view(spark, sf_dir)
    last = events.groupBy("sourcetype").agg(F.max("event_id").alias("last"))
    rows = events.join(F.broadcast(last), "sourcetype")  # one row for each type of event
    envelope = F.to_json(
        F.struct(
            (F.col("event_id") % 10 == 3).alias("preview"),
            F.col("event_id").alias("offset"),
            F.when((F.col("event_id") == F.col("last")) & (F.col("sourcetype") != "error"), True).alias("lastrow"),
            F.struct(F.col("event_id").cast("string").alias("id"), F.col("_raw").alias("raw")).alias("result"),
        )
    )
    path = sinks.scratch_dir(spark, "export")
    rows.select("sourcetype", envelope.alias("value")).write.partitionBy("sourcetype").text(path)
    return path


@query("export_completeness", f"""WITH {EVENTS} SELECT event_type AS stream, count_if(event_id % 10 <> 3)::BIGINT AS rows, event_type <> 'error' AND max(event_id) % 10 <> 3 AS complete FROM ev GROUP BY event_type
UNION ALL SELECT 'none', 0, false""")
def export_completeness(spark, sf_dir):
    envelopes = ev.read_export_stream(spark, _export_files(spark, sf_dir))
    envelopes = envelopes.withColumn("stream", F.regexp_extract("stream", "sourcetype=([^/]+)/", 1))
    kinds = ev.events_view(spark, sf_dir).select(F.col("sourcetype").alias("stream")).distinct()
    expected = kinds.unionByName(kinds.limit(1).select(F.lit("none").alias("stream")))
    return ev.stream_complete(envelopes, expected)


@query("sample_compare", f"""WITH {EVENTS}, {PIECES}, k AS (SELECT start, "end" FROM pc ORDER BY md5('s-' || start || '-' || "end"), start LIMIT 5)
SELECT event_id, 'second' AS side FROM ev JOIN k ON t >= start AND t < "end" WHERE event_id % 97 = 0""")
def sample_compare(spark, sf_dir):
    """A sample of chunks is extracted again and compared with what was written, as multisets."""
    events, plan = pieces(spark, sf_dir)
    sample = ch.sample_chunks(plan.withColumn("status", F.lit("done")), 5, "s")
    line = lambda df: df.select("event_id")
    written = line(ch.assign_chunks(events.where("event_id % 97 <> 0"), sample))
    return ch.same_content(written, line(ch.assign_chunks(events, sample)))
