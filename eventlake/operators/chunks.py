"""Assigning events to chunks, counting, overflow and outcomes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.names import free_names, refuse_names
from eventlake.functions.times import day_of

BROADCAST_CHUNKS = 500_000
#: Seconds of the slots by which events find chunks, and how many rows more than two for each chunk these may take.
SLOTS = (3600, 600, 60, 10, 1)
MORE_SLOTS = 10_000


def small(df: DataFrame, rows: int, limit: int = BROADCAST_CHUNKS) -> DataFrame:
    """Mark a side of a join for broadcasting if its counted rows are few; else it is shuffled."""
    return F.broadcast(df) if rows <= limit else df


def _slots(chunks: DataFrame) -> tuple[int, int]:
    """(length, rows): the shortest slots of the ladder that hardly add rows to the chunks when these are listed by slot, else hours."""
    rows = {s: F.sum(F.abs(F.floor((F.col("chunk_end") - 1) / s) - F.floor(F.col("chunk_start") / s)) + 1) for s in SLOTS}
    n, *found = chunks.agg(F.count("*"), *[F.coalesce(r, F.lit(0)) for r in rows.values()]).first()
    length = min((s for s, r in zip(SLOTS, found) if r <= 2 * n + MORE_SLOTS), default=SLOTS[0])
    return length, found[SLOTS.index(length)]


def assign_chunks(events: DataFrame, chunks: DataFrame, zone: str = "UTC", keys: tuple[str, ...] = ("start", "end")) -> DataFrame:
    """Events with the chunk they fall in: an equality on the day and slot with the range as a further condition.

    Chunks never cross a day. A chunk is listed under each slot of time that it touches, so that a day cut into
    many chunks does not compare each event with all of them; slots are hours, or shorter for short chunks. Events may have columns of any name but those of the
    chunk, which begin with ``chunk_``; they are never changed.
    """
    named = [f"chunk_{k}" for k in dict.fromkeys((*keys, "start", "end", "day"))]
    refuse_names(events, named)
    right = chunks.select(*[F.col(k[6:]).alias(k) for k in named])
    slot, day, at = free_names("slot", "day", "at", beside=[events, right])
    length, rows = _slots(right)  # rows: chunks by slot, what would be broadcast
    left = events.withColumn(slot, F.floor(F.col("t") / length)).withColumn(day, day_of(F.col("t"), zone))
    slots = F.sequence(F.floor(F.col("chunk_start") / length), F.floor((F.col("chunk_end") - 1) / length))
    right = right.withColumn(at, F.explode(slots))
    inside = (F.col("t") >= F.col("chunk_start")) & (F.col("t") < F.col("chunk_end"))
    joined = left.join(small(right, rows), (F.col(day) == F.col("chunk_day")) & (F.col(slot) == F.col(at)) & inside)
    return joined.drop(slot, day, at)


def chunk_counts(events: DataFrame, chunks: DataFrame, zone: str = "UTC") -> DataFrame:
    """Events of every chunk, zero included: counts by second are assigned, not events."""
    seconds = events.groupBy("t").agg(F.count("*").alias("n"))
    counts = assign_chunks(seconds, chunks, zone).groupBy("chunk_start", "chunk_end").agg(F.sum("n").alias("n"))
    same = (F.col("start") == F.col("chunk_start")) & (F.col("end") == F.col("chunk_end"))
    return chunks.join(counts, same, "left").drop("chunk_start", "chunk_end").withColumn("n", F.coalesce("n", F.lit(0)))


def expect_exports(chunks: DataFrame, events: DataFrame, zone: str = "UTC") -> DataFrame:
    """Export leaves without an expected count get one by counting; all other chunks stay as they are."""
    blind = (F.col("status") != "split") & (F.col("mode") == "export") & F.col("expected").isNull()
    counted = chunk_counts(events, chunks.where(blind).select("day", "start", "end").distinct(), zone)
    s, e, n = free_names("s", "e", "counted", beside=[chunks])
    counted = counted.select(F.col("start").alias(s), F.col("end").alias(e), F.col("n").alias(n))
    joined = chunks.join(counted, blind & (F.col("start") == F.col(s)) & (F.col("end") == F.col(e)), "left")
    return joined.withColumn("expected", F.coalesce("expected", n)).select(*chunks.columns)


def plan_vs_written(plan: DataFrame, written: DataFrame) -> DataFrame:
    """Expected against written by chunk: null ``matches`` where nothing was expected to be known."""
    joined = plan.join(written.select("start", "end", F.col("n").alias("written")), ["start", "end"], "left")
    joined = joined.withColumn("written", F.coalesce("written", F.lit(0)))
    return joined.withColumn("matches", F.col("expected") == F.col("written"))


def remaining_chunks(chunks: DataFrame, finished: DataFrame) -> DataFrame:
    """Leaves that are not finished; split parents are never queued again."""
    return chunks.where("status <> 'split'").join(finished.select("start", "end"), ["start", "end"], "left_anti")


def overflow_chunks(counted: DataFrame, cap: int) -> DataFrame:
    return counted.where(F.col("n") > cap)


def _bisect_tree(cap: int, least: int):
    def work(seconds: pd.DataFrame) -> pd.DataFrame:
        start, end, day = int(seconds["start"].iat[0]), int(seconds["end"].iat[0]), seconds["day"].iat[0]
        seconds = seconds.sort_values("t")
        t, run = seconds["t"].to_numpy(), np.append(0, seconds["n"].cumsum())
        count = lambda a, b: int(run[np.searchsorted(t, b)] - run[np.searchsorted(t, a)])
        out, todo = [], [(start, end, None)]
        while todo:
            a, b, parent = todo.pop()
            n = count(a, b)
            if n <= cap:
                out.append((day, a, b, parent, n, "done", "job", False))
            elif b - a > least and b - a >= 2:
                out.append((day, a, b, parent, n, "split", "job", False))
                middle = a + (b - a) // 2
                todo += [(a, middle, f"{a}-{b}"), (middle, b, f"{a}-{b}")]
            else:
                out.append((day, a, b, parent, n, "done", "export", True))
        return pd.DataFrame(out, columns=["day", "start", "end", "parent", "n", "status", "mode", "hot"])

    return work


def bisect_overflow(chunks: DataFrame, events: DataFrame, cap: int, least: int = 1, zone: str = "UTC") -> DataFrame:
    """The whole split tree of chunks above the cap, from counts by second: parents, halves and leaves.

    Chunks at or below the cap are single leaves. A range that can't be split any more is exported.
    """
    seconds = events.groupBy("t").agg(F.count("*").alias("n"))
    assigned = assign_chunks(seconds, chunks, zone).select(
        F.col("chunk_day").alias("day"), F.col("chunk_start").alias("start"), F.col("chunk_end").alias("end"), "t", "n"
    )
    none = chunks.select("day", "start", "end", F.col("start").alias("t"), F.lit(0).cast("long").alias("n"))
    tree = "day string, start long, end long, parent string, n long, status string, mode string, hot boolean"
    return assigned.unionByName(none).groupBy("day", "start", "end").applyInPandas(_bisect_tree(cap, least), tree)


def paginate(assigned: DataFrame, size: int, order: list[str]) -> DataFrame:
    """Page numbers of the rows of each chunk, in the order of ``order``, whose first column has the time.

    Rows are ranked within their second only, behind the counts of the seconds before it, so a task never
    sorts a whole chunk.
    """
    refuse_names(assigned, ["page"])
    chunk, first = ["chunk_start", "chunk_end"], order[0]
    n, ahead = free_names("n", "before", beside=[assigned])
    counts = assigned.groupBy(*chunk, first).agg(F.count("*").alias(n))
    before = Window.partitionBy(*chunk).orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn(ahead, F.coalesce(F.sum(n).over(before), F.lit(0))).drop(n)
    within = Window.partitionBy(*chunk, first).orderBy(*order)
    place = F.col(ahead) + F.row_number().over(within) - 1
    return assigned.join(offsets, [*chunk, first]).withColumn("page", F.floor(place / size).cast("long")).select(*assigned.columns, "page")


def capped_result(assigned: DataFrame, cap: int, order: list[Column | str] | None = None) -> DataFrame:
    """At most ``cap`` rows of each chunk in an order (default: latest first, then by event), and whether the chunk was cut.

    Spark limits ranks before the shuffle, so a task gets no more than ``cap`` rows of a chunk from each other.
    """
    refuse_names(assigned, ["truncated"])
    chunk = ["chunk_start", "chunk_end"]
    rank, cut = free_names("rank", "cut", beside=[assigned])
    latest = Window.partitionBy(*chunk).orderBy(*(order or [F.col("t").desc(), "event_id"]))
    ranked = assigned.withColumn(rank, F.row_number().over(latest)).where(F.col(rank) <= cap).drop(rank)
    whole = assigned.groupBy(*chunk).agg((F.count("*") > cap).alias(cut))
    return ranked.join(whole, chunk).withColumn("truncated", F.col(cut)).select(*assigned.columns, "truncated")


def chunk_mode(mode: str, hot: Column, expected: Column, cap: int) -> Column:
    if mode == "export":
        return F.lit("export")
    return F.when(hot & (F.coalesce(expected, F.lit(0)) > cap), "export").otherwise("job")


def chunk_outcome(truncated: Column, troubles: Column, expected: Column, written: Column, attempts: Column, most: int) -> Column:
    """Overflow comes first, then trouble, then a wrong count; both are tried again while attempts are left."""
    last = attempts >= most
    return (
        F.when(truncated, "overflow")
        .when(F.size(troubles) > 0, F.when(last, "failed").otherwise("retry"))
        .when(expected.isNotNull() & (expected != written), F.when(last, "mismatch").otherwise("retry"))
        .otherwise("done")
    )


def pending_order(chunks: DataFrame, now: Column, oldest_first: bool = True) -> DataFrame:
    ready = chunks.where("status = 'pending'").where(F.coalesce(F.col("not_before") <= now, F.lit(True)))
    return ready.orderBy(F.col("start").asc() if oldest_first else F.col("start").desc())


def same_content(a: DataFrame, b: DataFrame) -> DataFrame:
    """Lines that are in only one of two multisets."""
    return a.exceptAll(b).withColumn("side", F.lit("first")).unionByName(b.exceptAll(a).withColumn("side", F.lit("second")))


def sample_chunks(chunks: DataFrame, n: int, seed: str) -> DataFrame:
    """``n`` done chunks picked by a seeded hash of their range; the same ones each time."""
    pick = F.md5(F.concat_ws("-", F.lit(seed), F.col("start").cast("string"), F.col("end").cast("string")).cast("binary"))
    return chunks.where("status = 'done'").orderBy(pick, "start").limit(n)


def key_uniqueness(events: DataFrame, keys: list[str], exact: bool = True) -> DataFrame:
    """Rows against distinct keys; informational, nothing is ever dropped."""
    distinct = F.count_distinct(*keys) if exact else F.approx_count_distinct(F.struct(*keys))
    return events.agg(F.count("*").alias("rows"), distinct.alias("keys"))
