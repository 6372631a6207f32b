"""Extraction while data arrives, with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.functions.encoding import encode_json
from eventlake.sources.events import pin_snapshot


def stream_events(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def extract_stream(events: DataFrame, out: str, checkpoint: str, ts: str = "ts") -> StreamingQuery:
    """Append events as gzip NDJSON by day and hour; the checkpoint resumes without loss or repeats."""
    rows = events.select(F.date_format(ts, "yyyy-MM-dd").alias("day"), F.date_format(ts, "HH").alias("hour"), encode_json(events).alias("value"))
    writer = rows.writeStream.format("text").partitionBy("day", "hour").option("compression", "gzip")
    return writer.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def live_histogram(events: DataFrame, span: str, lateness: str, ts: str = "ts") -> DataFrame:
    """Counts by tumbling window; a window is emitted once the watermark has passed it."""
    counts = events.withWatermark(ts, lateness).groupBy(F.window(ts, span)).count()
    return counts.select(F.unix_timestamp("window.start").alias("start"), F.unix_timestamp("window.end").alias("end"), "count")


def split_late(main: str, delta: str, pin: int | None, index_time: str = "_indextime") -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: rows indexed before the pin go to ``main``, later ones to ``delta``; none is dropped.

    Each batch has a folder of its own name, so a batch that is run again replaces itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        pin_snapshot(batch, pin, index_time).write.mode("overwrite").parquet(f"{main}/batch={number}")
        if pin is not None:
            batch.where(F.coalesce(F.col(index_time) >= pin, F.lit(True))).write.mode("overwrite").parquet(f"{delta}/batch={number}")

    return write
