"""Queries on tables that grow, merges of intervals, and differences of outputs, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions import encoding, times
from eventlake.operators import chunks as ch
from eventlake.operators import count_tree, differences, interval_merge, planning, sketches
from eventlake.plans.event_queries import BINS, EVENTS, FIELDS, LINE, PACKED, PAGE, PIECES, SPAN, TARGET, packed, pieces, ranges, view
from eventlake.sources import events as ev
from eventlake.sources import members, pages, sinks
from eventlake.streaming import completeness

QUERIES: dict = {}
ORACLES: dict = {}

DAY, BUCKET = ev.DAY, 3600
#: Days behind the range's start at which the table's batches end, by index time.
STEPS = (8, 17)


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        ORACLES[name] = sql
        return f

    return add


def batches(events: DataFrame, lo: int) -> list[DataFrame]:
    """The events as they were indexed: up to the first step, up to the second, and the rest."""
    edges = [None, *[lo + s * DAY for s in STEPS], None]
    found = []
    for a, b in zip(edges, edges[1:]):
        part = events if a is None else events.where(F.col("_indextime") >= a)
        found.append(part if b is None else part.where(F.col("_indextime") < b))
    return found


PINNED = """q(id, a, b, p, o) AS (VALUES (1, 0, 86400, NULL, NULL), (2, 3600 * 5 + 17, 86400 * 9 + 4321, 8, NULL), (3, 12345, 86400 * 20 + 7, 17, 8), (4, 86400 * 7 - 61, 86400 * 8 + 61, 8, 7),
  (5, 100, 101, 17, 1), (6, 86400 * 3 + 599, 86400 * 3 + 1201, 12, 3), (7, 0, 86400 * 40, NULL, 17), (8, 500, 500, NULL, NULL))"""


@query("pin_counts", f"""WITH {EVENTS}, {PINNED}
SELECT id::BIGINT AS id, count(event_id)::BIGINT AS n, count(CASE WHEN indextime >= lo + o * 86400 THEN 1 END)::BIGINT AS late
FROM q CROSS JOIN r LEFT JOIN ev ON t >= lo + a AND t < lo + b AND (p IS NULL OR indextime < lo + p * 86400) GROUP BY id""")
def pin_counts(spark, sf_dir):
    """Ranges under pins and between two pins, from a tree that grew in three batches."""
    events, lo, _ = view(spark, sf_dir)
    path = sinks.scratch_dir(spark, "tree")
    for k, batch in enumerate(batches(events, lo)):
        count_tree.grow(batch, path, str(k), BUCKET)
    asked = [(1, 0, DAY, None, None), (2, 3600 * 5 + 17, DAY * 9 + 4321, 8, None), (3, 12345, DAY * 20 + 7, 17, 8), (4, DAY * 7 - 61, DAY * 8 + 61, 8, 7)]
    asked += [(5, 100, 101, 17, 1), (6, DAY * 3 + 599, DAY * 3 + 1201, 12, 3), (7, 0, DAY * 40, None, 17), (8, 500, 500, None, None)]
    at = lambda days: None if days is None else lo + days * DAY
    rows = [(i, lo + a, lo + b, at(p), at(o)) for i, a, b, p, o in asked]
    questions = spark.createDataFrame(rows, "id long, start long, end long, pin long, old_pin long")
    return count_tree.counts_at(count_tree.prefixes(count_tree.read_tree(spark, path)), questions, BUCKET).select("id", "n", "late")


def grown_plan(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(bins, plan) of the whole table, made of its first batch and changed by those that came later."""
    events, lo, hi = view(spark, sf_dir)
    path = sinks.scratch_dir(spark, "tree")
    first, *later = batches(events, lo)
    count_tree.grow(first, path, "0", BUCKET)
    bins = sinks.keep(planning.refine_seconds(count_tree.seconds_of(count_tree.read_tree(spark, path)), lo, hi, SPAN, TARGET), "bins")
    plan = sinks.keep(planning.pack(bins, ranges(spark, lo, hi), TARGET), "plan")
    for k, batch in enumerate(later, 1):
        count_tree.grow(batch, path, str(k), BUCKET)
        tree = count_tree.read_tree(spark, path)
        added = tree.where(F.col("batch") == str(k))
        bins = sinks.keep(count_tree.refine_again(bins, tree, added, lo, hi, SPAN, TARGET), "bins")
        plan = sinks.keep(count_tree.pack_again(plan, bins, added, lo, hi, TARGET), "plan")
    return bins, plan


@query("grown_bins", f"""WITH {EVENTS}, {BINS} SELECT s::BIGINT AS start, e::BIGINT AS "end", c::BIGINT AS count FROM bins""")
def grown_bins(spark, sf_dir):
    return grown_plan(spark, sf_dir)[0]


@query("grown_plan", f"WITH RECURSIVE {EVENTS}, {PACKED} SELECT * FROM pack")
def grown_plan_query(spark, sf_dir):
    return grown_plan(spark, sf_dir)[1]


@query("pinned_extraction", f"""WITH {EVENTS}, n AS (SELECT strftime(make_timestamp(t * 1000000), '%Y-%m-%d') AS day, count(*) AS n FROM ev, r WHERE indextime < lo + {STEPS[0]} * 86400 GROUP BY ALL)
SELECT day, n::BIGINT AS expected, n::BIGINT AS written FROM n""")
def pinned_extraction(spark, sf_dir):
    """Plan and extraction under one pin, while the table grows between them: days as expected and as written."""
    events, lo, hi = view(spark, sf_dir)
    path, pin = sinks.scratch_dir(spark, "table"), lo + STEPS[0] * DAY
    first, *later = batches(events, lo)
    first.write.parquet(path)
    live = lambda: spark.read.schema(events.schema).parquet(path)
    plan = sinks.keep(planning.plan(ev.pin_snapshot(live(), pin), lo, hi, SPAN, TARGET), "plan")
    for batch in later:
        batch.write.mode("append").parquet(path)
    times.check_range(lo, hi)
    fields = encoding.default_fields(False, ["t", *encoding.DEFAULT_FIELDS[2:5]], "raw")
    found = ev.extract_events(live(), lo, hi, pin)
    out = sinks.scratch_dir(spark, "output")
    members.write_members(ch.assign_chunks(found, plan), out, fields)
    written = members.read_members(spark, out).groupBy("day").agg(F.count("*").alias("written"))
    expected = plan.groupBy("day").agg(F.sum("expected").alias("expected")).where("expected > 0")
    return expected.join(written, "day", "full_outer").select("day", "expected", "written")


@query("interval_merge", f"""WITH RECURSIVE {EVENTS}, {PACKED} SELECT event_id, start AS chunk_start, "end" AS chunk_end, expected AS chunk_expected FROM ev JOIN pack ON t >= start AND t < "end" WHERE start % 86400 < 64800 """)
def interval_merge_query(spark, sf_dir):
    """Events of the chunks that begin before 18 hours, by one merge; those behind them have none."""
    events, plan = packed(spark, sf_dir)
    some = plan.where("start % 86400 < 64800")
    return interval_merge.merge_chunks(events, some, ("start", "end", "expected")).select("event_id", "chunk_start", "chunk_end", "chunk_expected")


@query("merkle_differences", f"""WITH {EVENTS}, l AS (SELECT t // 86400 * 86400 AS day, event_id, {LINE} AS line FROM ev)
SELECT day::BIGINT AS day, line, 1::BIGINT AS off FROM l WHERE event_id % 997 IN (0, 1) UNION ALL SELECT day, line || ' ', -1 FROM l WHERE event_id % 997 = 0 UNION ALL SELECT day, line, -1 FROM l WHERE event_id % 997 = 2""")
def merkle_differences(spark, sf_dir):
    """Lines by day against those of an output where some are changed, missing or repeated: just these, by descending two trees."""
    events, _, _ = view(spark, sf_dir)
    day = (F.floor(F.col("t") / DAY) * DAY).cast("long")
    lines = sinks.keep(events.select(day.alias("day"), "event_id", encoding.encode_json(events, FIELDS).alias("line")), "lines")
    rest = F.col("event_id") % 997
    other = lines.where(rest != 1).withColumn("line", F.when(rest == 0, F.concat("line", F.lit(" "))).otherwise(F.col("line")))
    other = other.unionByName(lines.where(rest == 2)).select("day", "line")
    paths = [sinks.scratch_dir(spark, "digests") for _ in range(2)]
    for side, path in zip((lines, other), paths):
        differences.store_tree(differences.digest_tree(side, ["day"]), path)
    leaves = differences.different_leaves(*[spark.read.parquet(p) for p in paths], ["day"])
    return differences.different_lines(lines.select("day", "line"), other, leaves, ["day"])


@query("digest_roots", f"""WITH {EVENTS}, l AS (SELECT t // 86400 * 86400 AS day FROM ev) SELECT day::BIGINT AS day, count(*)::BIGINT AS rows, true AS same FROM l GROUP BY day""")
def digest_roots(spark, sf_dir):
    """Root digests by day of the lines, and whether those of the lines in another order and dealt otherwise are the same."""
    events, _, _ = view(spark, sf_dir)
    day = (F.floor(F.col("t") / DAY) * DAY).cast("long")
    lines = events.select(day.alias("day"), encoding.encode_json(events, FIELDS).alias("line"))
    one = differences.root_digests(differences.digest_tree(lines, ["day"]), ["day"])
    two = differences.root_digests(differences.digest_tree(lines.repartition(7, "line"), ["day"]), ["day"]).withColumnRenamed("digest", "again")
    return one.join(two, ["day", "rows"]).select("day", "rows", (F.col("digest") == F.col("again")).alias("same"))


STREAMS = """s AS (SELECT event_type || ' ' || strftime(make_timestamp(t * 1000000), '%Y-%m-%d') AS chunk, event_type, count_if(event_id % 10 <> 3) AS rows, count_if(event_id % 500 = 4) AS malformed, max(t) AS last FROM ev GROUP BY ALL)"""


@query("stream_chunk_states", f"""WITH {EVENTS}, {STREAMS}
SELECT chunk, rows::BIGINT AS rows, malformed::BIGINT AS malformed, CASE WHEN event_type <> 'error' AND malformed = 0 THEN 'complete' ELSE 'failed' END AS state FROM s
WHERE event_type <> 'error' OR last + 86400 <= (SELECT max(t) FROM ev) - 600""")
def stream_chunk_states(spark, sf_dir):
    """Chunks (types by day) of a stream that is read in four parts, and started anew for each: complete or timed out, once each.

    Errors never get their last row; tenths are previews; some lines are malformed.
    """
    events, lo, hi = view(spark, sf_dir)
    chunk = F.concat_ws(" ", "sourcetype", times.day_of(F.col("t")))
    rows = events.withColumn("chunk", chunk)
    last = rows.groupBy(F.col("chunk").alias("c")).agg(F.max(F.struct("t", "event_id")).alias("end"))
    rows = rows.join(last, F.col("chunk") == F.col("c"))
    envelopes = rows.select(
        "chunk", F.timestamp_seconds("t").alias("ts"), (F.col("event_id") % 10 == 3).alias("preview"), F.lit(True).alias("has_result"), (F.col("event_id") % 500 == 4).alias("malformed"), "t",
        ((F.col("event_id") == F.col("end.event_id")) & (F.col("sourcetype") != "error")).alias("is_last"),
    )
    # A mark on a preview counts nowhere, so the mark is a line of its own, without a result.
    marks = envelopes.where("is_last").withColumns({"preview": F.lit(False), "has_result": F.lit(False), "malformed": F.lit(False)})
    parts = envelopes.withColumn("lastrow", F.lit(False)).unionByName(marks.withColumn("lastrow", F.lit(True))).drop("is_last")
    parts = sinks.keep(parts, "envelopes")
    path, out, state = (sinks.scratch_dir(spark, n) for n in ("stream", "states", "checkpoint"))
    schema = parts.drop("t").schema
    edges = [lo + k * (hi - lo) // 4 + (7 * 3600 if 0 < k < 4 else 0) for k in range(5)]
    for a, b in zip(edges, edges[1:]):
        parts.where((F.col("t") >= a) & (F.col("t") < b)).drop("t").write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        completeness.start(completeness.chunk_states(stream, DAY, "600 seconds"), out, state).awaitTermination()
    return spark.read.schema(completeness.OUTPUT).parquet(out)


@query("damaged_exports", f"""WITH {EVENTS}, k AS (SELECT *, event_id % 53 = 5 AS cut, event_id % 10 = 3 AS preview FROM ev)
SELECT event_type AS stream, count_if(NOT cut AND NOT preview)::BIGINT AS rows, count_if(cut)::BIGINT AS malformed, count_if(event_id % 29 = 1)::BIGINT AS replaced,
  count_if(cut) = 0 AND bool_or(NOT cut AND event_id % 101 = 7) AS complete FROM k GROUP BY event_type""")
def damaged_exports(spark, sf_dir):
    """Streams with cut, blank and carriage-return lines and invalid bytes: what each has, and that those with a cut line are not complete."""
    kept = ev.read_export_stream(spark, damaged_export_files(spark, sf_dir), malformed="keep")
    kept = kept.withColumn("stream", F.regexp_extract("stream", "sourcetype=([^/]+)/", 1))
    return ev.stream_state(kept, kept.select("stream").distinct())


@query("export_values", f"""WITH {EVENTS} SELECT '{{"id":' || event_id || ',"tags":["' || event_type || '","x"],"raw":' || to_json(raw || CASE WHEN event_id % 29 = 1 THEN '�' ELSE '' END) || '}}' AS line FROM ev WHERE event_id % 53 <> 5 AND event_id % 10 <> 3""")
def export_values(spark, sf_dir):
    """Results as output lines: lists and numbers stay what they are."""
    kept = ev.read_export_stream(spark, damaged_export_files(spark, sf_dir), malformed="keep")
    return ev.export_lines(kept, ["id", "tags", "raw", "missing"]).select("line")


def damaged_export_files(spark, sf_dir: str) -> str:
    """Events as export envelopes by type, with list values; some lines are cut, have invalid bytes, or blank lines around them."""
    events = ev.events_view(spark, sf_dir)
    result = F.struct(F.col("event_id").alias("id"), F.col("_raw").alias("raw"), F.array("sourcetype", F.lit("x")).alias("tags"))
    envelope = F.to_json(F.struct((F.col("event_id") % 10 == 3).alias("preview"), F.when(F.col("event_id") % 101 == 7, True).alias("lastrow"), result.alias("result")))
    # An invalid byte inside the raw text.
    envelope = F.when(F.col("event_id") % 29 == 1, F.concat(F.substring_index(envelope, '","tags"', 1), F.unhex(F.lit("FF")).cast("string"), F.lit('","tags"'), F.substring_index(envelope, '","tags"', -1))).otherwise(envelope)
    line = F.when(F.col("event_id") % 53 == 5, F.expr("substring(envelope, 1, length(envelope) - 4)")).otherwise(F.col("envelope"))
    around = F.when(F.col("event_id") % 31 == 0, F.concat(F.lit("\r\n \t\n"), line, F.lit("\r"))).otherwise(line)
    path = sinks.scratch_dir(spark, "export")
    events.withColumn("envelope", envelope).select("sourcetype", around.alias("value")).write.partitionBy("sourcetype").text(path)
    return path


@query("key_sketches", f"""WITH {EVENTS}, q(id, a, b) AS (VALUES (1, 0, 0), (2, 0, 6), (3, 5, 20), (4, 0, 400), (5, 300, 310))
SELECT id::BIGINT AS id, count(event_id)::BIGINT AS rows, true AS within FROM q CROSS JOIN r LEFT JOIN ev ON t >= lo + a * 86400 AND t < lo + (b + 1) * 86400 GROUP BY id""")
def key_sketches(spark, sf_dir):
    """Rows of ranges of days, and whether their different keys are as many as sketches that were stored in two parts say."""
    events, lo, _ = view(spark, sf_dir)
    day = F.floor((F.col("t") - lo) / DAY)
    keys = ["_bkt", "_cd", "host"]
    first, *later = batches(events, lo)
    path = sinks.scratch_dir(spark, "sketches")
    sketches.day_sketches(first, keys, day).write.parquet(path)
    stored = spark.read.parquet(path)
    for batch in later:
        stored = sketches.merge_sketches(stored, sketches.day_sketches(batch, keys, day))
    ranges_ = spark.createDataFrame([(1, 0, 0), (2, 0, 6), (3, 5, 20), (4, 0, 400), (5, 300, 310)], "id long, first long, last long")
    found = sketches.distinct_keys(sinks.keep(stored, "sketches"), ranges_)
    inside = ranges_.join(events.withColumn("day", day), (F.col("day") >= F.col("first")) & (F.col("day") <= F.col("last")))
    exact = inside.groupBy("id").agg(F.count_distinct(*keys).alias("exact"))
    near = F.coalesce("exact", F.lit(0)).between(F.col("least"), F.col("most"))
    return found.join(exact, "id", "left").select("id", "rows", near.alias("within"))


@query("stored_pages", f"""WITH {EVENTS}, {PIECES}, k AS (SELECT start, event_id, row_number() OVER (PARTITION BY start ORDER BY t, event_id) - 1 AS i FROM ev JOIN pc ON t >= start AND t < "end")
SELECT start::BIGINT AS chunk_start, (i // {PAGE})::BIGINT AS page, count(*)::BIGINT AS n, arg_min(event_id, i) AS first_id, arg_max(event_id, i) AS last_id FROM k GROUP BY ALL""")
def stored_pages(spark, sf_dir):
    """Pages of all chunks, written in blocks of three pages and read again: rows, first and last event."""
    events, plan = pieces(spark, sf_dir)
    path = sinks.scratch_dir(spark, "pages")
    pages.write_pages(ch.assign_chunks(events.select("event_id", "t"), plan), path, PAGE, ["t", "event_id"], pages_of_block=3)
    place = F.struct("t", "event_id")
    return pages.read_pages(spark, path).groupBy("chunk_start", "page").agg(
        F.count("*").alias("n"), F.min_by("event_id", place).alias("first_id"), F.max_by("event_id", place).alias("last_id")
    )
