"""Histograms and chunk plans.

Counts by second are made once from the events; refinement, packing and bisection work on them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.names import free_names
from eventlake.functions.times import day_bounds, initial_span, next_span

CHUNK = "day string, start long, end long, expected long, hot boolean"


def per_second(events: DataFrame, column: str = "t") -> DataFrame:
    return events.groupBy(F.col(column).alias("t")).agg(F.count("*").alias("n"))


def histogram(events: DataFrame, span: int, start: int, end: int) -> DataFrame:
    """Non-empty bins of ``span`` seconds, clipped to the range."""
    at = (F.floor(F.col("t") / span) * span).cast("long")
    inside = events.where((F.col("t") >= start) & (F.col("t") < end))
    counts = inside.groupBy(at.alias("at")).agg(F.count("*").alias("count"))
    return counts.select(F.greatest("at", F.lit(start)).alias("start"), F.least(F.col("at") + span, F.lit(end)).alias("end"), "count")


def refine(events: DataFrame, start: int, end: int, span: int, target: int, least: int = 1) -> DataFrame:
    """Bins split down the ladder of spans until they hold at most ``target`` events or are ``least`` long.

    One pass: each second sees the counts of the bins around it at every level of the ladder, and
    belongs to the first that is final.
    """
    return refine_seconds(per_second(events), start, end, span, target, least)


def refine_seconds(seconds: DataFrame, start: int, end: int, span: int, target: int, least: int = 1) -> DataFrame:
    """:func:`refine` on counts by second (t, n) that were made before."""
    seconds = seconds.where((F.col("t") >= start) & (F.col("t") < end))
    spans = [span]
    while (s := next_span(spans[-1], least)) is not None:
        spans.append(s)
    lo, hi = F.lit(start), F.lit(end)
    final_start = final_end = None
    done = F.lit(False)
    for i, s in enumerate(spans):
        at = (F.floor(F.col("t") / s) * s).cast("long")
        seconds = seconds.withColumn(f"s{i}", F.greatest(at, lo)).withColumn(f"e{i}", F.least(at + s, hi))
        lo, hi = F.col(f"s{i}"), F.col(f"e{i}")
        seconds = seconds.withColumn(f"c{i}", F.sum("n").over(Window.partitionBy(f"s{i}")))
        final = (F.col(f"c{i}") <= target) | (hi - lo <= least) | F.lit(i == len(spans) - 1)
        final_start = F.when(final, lo) if final_start is None else F.coalesce(final_start, F.when(final, lo))
        final_end = F.when(final, hi) if final_end is None else F.coalesce(final_end, F.when(final, hi))
        done = done | final
    return seconds.groupBy(final_start.alias("start"), final_end.alias("end")).agg(F.sum("n").alias("count"))


def _days_touched(start: Column, end: Column, zone: str) -> Column:
    local = lambda second: F.to_date(F.from_utc_timestamp(F.timestamp_seconds(second), zone))
    return F.transform(F.sequence(local(start), local(end - 1)), lambda d: F.date_format(d, "yyyy-MM-dd"))


def overlapping(bins: DataFrame, zone: str = "UTC") -> DataFrame:
    """Bins that begin before an earlier one has ended; two such bins share a day, so days are compared alone."""
    touched, ended = free_names("touched", "ended", beside=[bins])
    w = Window.partitionBy(touched).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    by_day = bins.withColumn(touched, F.explode(_days_touched(F.col("start"), F.col("end"), zone)))
    return by_day.withColumn(ended, F.max("end").over(w)).where(F.col("start") < F.col(ended)).select(*bins.columns).distinct()


def _breaks(counts: np.ndarray, target: int) -> list[int]:
    """Where new chunks begin among bins in a row, so that each chunk takes all that fit: jumps over running sums."""
    upto = np.cumsum(counts)
    found, spent = [], 0
    while (at := int(np.searchsorted(upto, spent + target, side="right"))) < len(upto):
        found.append(at)
        spent = upto[at - 1]
    return found


def _pack_day(target: int):
    """The chunks of a day are the tiles between its edges: hot bins bring both of theirs, other chunks their start."""

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        day, opens, closes = rows["day"].iat[0], int(rows["ds"].iat[0]), int(rows["de"].iat[0])
        bins = rows.dropna(subset=["start"]).sort_values("start")[["start", "end", "count"]].astype("int64")
        start, end, count = (bins[c].to_numpy() for c in bins)
        if (start[1:] < end[:-1]).any():
            raise ValueError(f"bins overlap on {day}")
        known = not ((start < opens) | (end > closes)).any()
        start, end = start.clip(opens, closes), end.clip(opens, closes)
        hot = np.flatnonzero(count > target)
        edges = [opens, closes, *start[hot], *end[hot]]
        for run in np.split(np.arange(len(start)), hot):
            run = run[count[run] <= target]
            edges += [start[run[k]] for k in _breaks(count[run], target)]
        edges = np.unique(edges)
        sums = np.bincount(np.searchsorted(edges, start, side="right") - 1, count, len(edges))[:-1].astype(np.int64)
        return pd.DataFrame(
            {"day": day, "start": edges[:-1], "end": edges[1:], "expected": pd.array(sums if known else [None] * len(sums), "Int64"), "hot": np.isin(edges[:-1], start[hot])}
        )

    return work


def pack(bins: DataFrame, ranges: DataFrame, target: int, zone: str = "UTC", only: DataFrame | None = None) -> DataFrame:
    """Chunks that tile the days of the range, with at most ``target`` events each unless hot.

    Bins of a day are taken in order; empty time belongs to the chunk before it. A bin above the target
    is a hot chunk of its own. Where a bin reaches over the edge of a day, counts of that day are unknown.
    Bins that overlap are an error. With ``only`` (day), just these days are packed.
    """
    days = day_bounds(ranges, zone).select("day", F.col("start").alias("ds"), F.col("end").alias("de"))
    days = days if only is None else days.join(only.select("day").distinct(), "day", "left_semi")
    # Each bin finds its days by equality.
    touched = bins.withColumn("day", F.explode(_days_touched(F.col("start"), F.col("end"), zone)))
    return days.join(touched, "day", "left").groupBy("day").applyInPandas(_pack_day(target), CHUNK)


def fixed_chunks(ranges: DataFrame, span: int, zone: str = "UTC") -> DataFrame:
    """Windows of ``span`` seconds that start anew each day; their counts are unknown."""
    days = day_bounds(ranges, zone)
    starts = days.withColumn("s", F.explode(F.sequence("start", F.col("end") - 1, F.lit(span).cast("long"))))
    return starts.select(
        "day", F.col("s").alias("start"), F.least(F.col("s") + span, "end").alias("end"), F.lit(None).cast("long").alias("expected"), F.lit(False).alias("hot")
    )


def plan(events: DataFrame, start: int, end: int, span: int, target: int, least: int = 1, use_histogram: bool = True, zone: str = "UTC") -> DataFrame:
    """Refined and packed chunks, or fixed ones without a histogram."""
    ranges = events.sparkSession.range(1).select(F.lit(start).cast("long").alias("start"), F.lit(end).cast("long").alias("end"))
    if not use_histogram:
        return fixed_chunks(ranges, span, zone)
    bins = refine(events, start, end, initial_span(start, end, span), target, least)
    return pack(bins, ranges, target, zone)


def plan_summary(chunks: DataFrame) -> DataFrame:
    return chunks.agg(
        F.count("*").alias("chunks"),
        F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"),
        F.count("expected").alias("known"),
        F.count_if("hot").alias("hot"),
    )

