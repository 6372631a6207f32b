"""Streams over the events table, read back as tables, with the SQL that checks them.

Each stream takes all files that are there and stops; its sink is then read as a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.plans.event_queries import EVENTS, PIN_DAYS, view
from eventlake.sources import events as ev
from eventlake.sources import sinks
from eventlake.streaming import live

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        ORACLES[name] = sql
        return f

    return add


def stream(spark, sf_dir: str) -> DataFrame:
    schema = ev.read_table(spark, sf_dir, "events").schema
    # As a pattern, the path may name a file as well as a folder.
    return live.stream_events(spark, f"{sf_dir}/events.parque[t]", schema)


@query("stream_extract", """SELECT strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hour, count(*)::BIGINT AS lines FROM events GROUP BY ALL""")
def stream_extract(spark, sf_dir):
    """Lines of the extraction by day and hour, after it was started twice."""
    out, state = sinks.scratch_dir(spark, "stream"), sinks.scratch_dir(spark, "state")
    for _ in range(2):
        live.extract_stream(stream(spark, sf_dir), out, state).awaitTermination()
    lines = spark.read.option("lineSep", "\n").text(out)
    hour = F.lpad(F.col("hour").cast("string"), 2, "0")
    return lines.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"), hour.alias("hour")).agg(F.count("*").alias("lines"))


@query("stream_histogram", f"""WITH {EVENTS}, w AS (SELECT t // 3600 * 3600 AS start, count(*) AS count FROM ev GROUP BY ALL)
SELECT start::BIGINT AS start, (start + 3600)::BIGINT AS "end", count::BIGINT AS count FROM w WHERE (start + 3600) * 1000 <= (SELECT epoch_ms(max(ts)) FROM events) - 600000""")
def stream_histogram(spark, sf_dir):
    """Windows that the watermark has passed, ten minutes behind the latest event."""
    counts = live.live_histogram(stream(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")), "1 hour", "10 minutes")
    out, state = sinks.scratch_dir(spark, "windows"), sinks.scratch_dir(spark, "state")
    writer = counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(counts.schema).parquet(out)


@query("stream_late", f"""WITH {EVENTS} SELECT event_id, indextime AS _indextime, indextime >= lo + {PIN_DAYS} * 86400 AS late FROM ev, r""")
def stream_late(spark, sf_dir):
    """Events kept in the main output or, indexed behind the pin, in the one of late events."""
    _, lo, _ = view(spark, sf_dir)
    rows = stream(spark, sf_dir).withColumn("t", ev.epoch(F.col("ts")))
    rows = rows.select("event_id", (F.col("t") + (F.col("event_id") * 7919) % 3600).alias("_indextime"))
    main, delta, state = (sinks.scratch_dir(spark, n) for n in ("main", "delta", "state"))
    split = live.split_late(main, delta, lo + PIN_DAYS * ev.DAY)
    rows.writeStream.foreachBatch(split).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    sides = [spark.read.schema(rows.schema).parquet(path).withColumn("late", F.lit(late)) for path, late in ((main, False), (delta, True))]
    return sides[0].unionByName(sides[1]).select("event_id", "_indextime", "late")
