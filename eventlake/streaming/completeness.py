"""Completeness of export streams while they arrive, as a stateful stream with timers.

A chunk is emitted once: as complete when its marked last row comes, or as failed when nothing has come for it for longer
than the time-out, measured by event time. Its state is two numbers, kept until then; the checkpoint resumes it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

STATE = "rows long, malformed long, timer long"
OUTPUT = "chunk string, rows long, malformed long, state string"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Chunk(StatefulProcessor):
    def __init__(self, timeout: int):
        self.timeout = timeout * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", STATE)

    def _emit(self, key: tuple, rows: int, malformed: int, state: str) -> pd.DataFrame:
        self.seen.clear()
        return pd.DataFrame({"chunk": [key[0]], "rows": [rows], "malformed": [malformed], "state": [state]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, wrong, timer = self.seen.get() if self.seen.exists() else (0, 0, None)
        last, latest = False, 0
        for part in rows:
            n, wrong = n + int(part["has_row"].sum()), wrong + int(part["malformed"].sum())
            last = last or bool(part["last"].any())
            latest = max(latest, int(part["at"].max()))
        if timer is not None:
            self.handle.deleteTimer(timer)
        if last:
            yield self._emit(key, n, wrong, "complete" if not wrong else "failed")
        else:
            due = max(latest + self.timeout, timer or 0)
            self.handle.registerTimer(due)
            self.seen.update((n, wrong, due))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            n, wrong, _ = self.seen.get()
            yield self._emit(key, n, wrong, "failed")

    def close(self) -> None:
        pass


def chunk_states(envelopes: DataFrame, timeout: int, lateness: str, ts: str = "ts") -> DataFrame:
    """chunk, rows, malformed, state of the chunks of a stream of envelopes, each once it is complete or has failed.

    ``envelopes`` has chunk, an event time, preview, lastrow, malformed and has_result. Previews count nowhere, nor do their
    marks. A chunk whose last row came but which has malformed lines has failed. ``timeout`` is in seconds; rows that
    are behind the watermark (``lateness``) are dropped by Spark, so it must be longer than streams can lag.
    """
    plain = ~F.coalesce("preview", F.lit(False))
    rows = envelopes.withWatermark(ts, lateness).select(
        F.col("chunk").cast("string").alias("chunk"), ts,
        (plain & F.coalesce("has_result", F.lit(False))).alias("has_row"),
        (plain & F.coalesce("lastrow", F.lit(False))).alias("last"),
        F.coalesce("malformed", F.lit(False)).alias("malformed"),
        F.unix_millis(ts).alias("at"),
    )
    return rows.groupBy("chunk").transformWithStateInPandas(_Chunk(timeout), OUTPUT, "append", "EventTime")


def start(states: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the states to Parquet files; takes what is there and stops. Timers need the RocksDB state store."""
    spark = states.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        writer = states.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
        return writer.trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
