"""Queries on texts of searches, times, messages and bytes, derived from the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlake.functions import encoding, lint, messages, times
from eventlake.sources import events as ev

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


# Endings of searches, picked by event.
ENDINGS = [
    "", " earliest=-1d", " | outputlookup foo", " | head 10 | dedup host", " my_latest=1 foo.latest=2", " | stats count by host",
    " | fields _raw", " _Index_Latest = 5", " | Sort 0 _time | COLLECT index=x", " searchtimespanhours=1 latest=now",
]
HEADS = ["index=main type=", "  search index=main type=", "| tstats count where type=", "| inputlookup type=", "SEARCH type="]

SEARCHES = f"""s AS (SELECT event_id, ({HEADS!r})[1 + event_id % {len(HEADS)}] || event_type || ({ENDINGS!r})[1 + user_id % {len(ENDINGS)}] AS search FROM events)"""


def searches(spark, sf_dir):
    e = ev.read_table(spark, sf_dir, "events")
    pick = lambda words, n: F.element_at(F.array(*[F.lit(w) for w in words]), (1 + n % len(words)).cast("int"))
    return e.select("event_id", F.concat(pick(HEADS, F.col("event_id")), "event_type", pick(ENDINGS, F.col("user_id"))).alias("search"))


MODIFIER_SQL = rf"(?i)(?:^|[^\w.])({'|'.join(lint.TIME_MODIFIERS)})\s*="


@query("search_lint", f"""WITH {SEARCHES}, n AS (SELECT event_id, search AS raw, CASE WHEN trim(search) LIKE '|%' OR regexp_matches(trim(search), '(?i)^search\\b') THEN trim(search) ELSE 'search ' || trim(search) END AS search FROM s),
i AS (SELECT event_id, search, 'error' AS level, 'time modifier' AS kind, regexp_extract(search, '{MODIFIER_SQL}', 1) AS word FROM n
UNION ALL SELECT event_id, search, 'error', 'side effect', regexp_extract(search, '{lint.SIDE_EFFECT}', 1) FROM n
UNION ALL SELECT event_id, search, 'warning', 'whole set', unnest(regexp_extract_all(search, '{lint.WHOLE}', 1)) FROM n
UNION ALL SELECT event_id, search, 'warning', 'generating', CASE WHEN regexp_matches(search, '{lint.IGNORING}') THEN regexp_extract(search, '{lint.IGNORING}', 1) WHEN search LIKE '|%' THEN '|' ELSE '' END FROM n)
SELECT event_id, search, sha256(search) AS hash, regexp_matches(search, '{lint.WHOLE}') AS whole_set, level, kind, word FROM i WHERE word <> ''""")
def search_lint(spark, sf_dir):
    s = searches(spark, sf_dir).withColumn("search", lint.normalize_search(F.col("search")))
    s = s.withColumn("hash", lint.search_hash(F.col("search"))).withColumn("whole_set", lint.is_whole_set(F.col("search")))
    return lint.lint_searches(s)


@query("resolve_times", """WITH e AS (SELECT event_id, epoch_us(ts) AS us, event_id % 6 AS k FROM events), t AS (SELECT event_id, us // 1000000 AS s, us, k FROM e)
SELECT event_id, (CASE k WHEN 0 THEN s WHEN 1 THEN s WHEN 2 THEN s WHEN 3 THEN s - 7200 WHEN 4 THEN s - s % 86400 ELSE (s - 3 * 86400) - (s - 3 * 86400) % 3600 END)::BIGINT AS earliest,
(CASE k WHEN 0 THEN s WHEN 1 THEN s + 1 WHEN 2 THEN s WHEN 3 THEN s - 7200 WHEN 4 THEN s - s % 86400 ELSE (s - 3 * 86400) - (s - 3 * 86400) % 3600 END)::BIGINT AS latest FROM t""")
def resolve_times(spark, sf_dir):
    e = ev.read_table(spark, sf_dir, "events").select("event_id", times.epoch(F.col("ts")).alias("s"))
    second = F.col("s").cast("string")
    iso = F.date_format(F.timestamp_seconds("s"), "yyyy-MM-dd'T'HH:mm:ss")
    east = F.concat(F.date_format(F.timestamp_seconds(F.col("s") - 7200), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))
    kinds = [second, F.concat(second, F.lit(".4")), iso, east, F.lit("@d"), F.lit("-3d@h")]
    text = F.element_at(F.array(*kinds), (1 + F.col("event_id") % 6).cast("int"))
    return e.select(
        "event_id", times.resolve_time(text, F.col("s")).alias("earliest"), times.resolve_time(text, F.col("s"), round_up=True).alias("latest")
    )


MESSAGE = """CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '[]' WHEN 2 THEN '[{"type":"warn","text":"slow"}]' WHEN 3 THEN '[{"type":"Error","text":"bad"},{"type":"info"}]' ELSE '[{"text":"x"},{"type":"FATAL","text":"' || event_type || '"}]' END"""


@query("job_problems", """WITH e AS (SELECT event_id, event_type, event_id % 7 = 0 AS failed, event_id % 11 = 0 AS finalized, event_id % 5 AS k FROM events),
p AS (SELECT event_id, list_concat(CASE WHEN failed THEN ['job failed'] ELSE [] END, CASE WHEN finalized THEN ['job was finalized'] ELSE [] END) AS base,
CASE k WHEN 2 THEN ['WARN: slow'] ELSE [] END AS warn, CASE k WHEN 3 THEN ['ERROR: bad'] WHEN 4 THEN ['FATAL: ' || event_type] ELSE [] END AS bad FROM e)
SELECT event_id, array_to_string(list_concat(base, warn, bad), '; ') AS strict, array_to_string(list_concat(base, bad), '; ') AS lenient FROM p""")
def job_problems(spark, sf_dir):
    e = ev.read_table(spark, sf_dir, "events").withColumn("m", messages.parse_messages(F.expr(MESSAGE)))
    failed, finalized = F.col("event_id") % 7 == 0, F.col("event_id") % 11 == 0
    text = lambda strict: F.array_join(messages.problems(failed, finalized, F.col("m"), strict), "; ")
    return e.select("event_id", text(True).alias("strict"), text(False).alias("lenient"))


def _bytes(spark, sf_dir):
    """Texts as bytes; some get an invalid byte at their end, some a genuine U+FFFD."""
    docs = ev.read_table(spark, sf_dir, "documents")
    tail = F.when(F.col("doc_id") % 3 == 0, F.unhex(F.lit("FF20FE"))).when(F.col("doc_id") % 3 == 1, F.unhex(F.lit("EFBFBD"))).otherwise(F.unhex(F.lit("")))
    return docs.select("doc_id", "source", encoding.decode_tolerant(F.concat(F.coalesce("text", F.lit("")).cast("binary"), tail)).alias("d"))


@query("utf8_replacements", """SELECT doc_id, length(coalesce(text, ''))::BIGINT + CASE doc_id % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 0 END AS points, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 0 END::BIGINT AS replaced FROM documents""")
def utf8_replacements(spark, sf_dir):
    return _bytes(spark, sf_dir).select("doc_id", F.length("d.text").cast("long").alias("points"), F.col("d.replaced").alias("replaced"))


@query("utf8_policy", "SELECT source, sum(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 0 END)::BIGINT AS replaced, CASE WHEN max(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 0 END) > 0 THEN 'failed' ELSE 'done' END AS outcome FROM documents GROUP BY source")
def utf8_policy(spark, sf_dir):
    by = _bytes(spark, sf_dir).groupBy("source").agg(F.sum("d.replaced").alias("replaced"), F.max("d.replaced").alias("most"))
    return by.select("source", "replaced", F.when(F.col("most") > 0, "failed").otherwise("done").alias("outcome"))
