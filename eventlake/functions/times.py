"""Times, days and spans. Epochs are whole seconds; ranges are half-open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the planner: spans in seconds, and the most bins of a histogram.
SPAN_LADDER = (86400, 3600, 600, 60, 10, 1)
MAX_BINS = 40_000

UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def epoch(ts: Column) -> Column:
    """Epoch second of a timestamp with or without a zone; fractions are floored, also before 1970."""
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000)).cast("long")


def resolve_time(text: Column, now: Column, round_up: bool = False) -> Column:
    """Epoch second of a time text: a number, ISO 8601 (UTC if naive), or relative to ``now``.

    Relative texts are ``now``, ``[+-]N(s|m|h|d|w)``, a snap ``@(s|m|h|d)``, or both. Fractions are
    floored, or ceiled with ``round_up``. Other texts give null.
    """
    t = F.trim(text)
    number = F.when(t.rlike(r"^\d+(\.\d+)?$"), t.cast("decimal(28,9)"))
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.unix_micros(F.try_to_timestamp(F.regexp_replace(t, "Z$", "+00:00"))) / F.lit(1_000_000))
    pattern = r"^(now|[+-]\d+[smhdw])?(@[smhd])?$"
    relative = t.rlike(pattern) & (F.length(t) > 0)
    amount = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(t, r"^[+-](\d+)[smhdw]", 1), F.lit("")), F.lit("999999999")).cast("long"), F.lit(0))
    units = F.create_map(*[F.lit(x) for pair in UNIT_SECONDS.items() for x in pair])
    unit = F.coalesce(F.element_at(units, F.regexp_extract(t, r"^[+-]\d+([smhdw])", 1)), F.lit(0))
    moved = now + F.when(t.startswith("-"), -1).otherwise(1) * amount * unit
    snap = F.coalesce(F.element_at(units, F.regexp_extract(t, r"@([smhd])$", 1)), F.lit(1))
    value = F.coalesce(number.cast("double"), iso, F.when(relative, (moved - F.pmod(moved, snap)).cast("double")))
    return (F.ceil(value) if round_up else F.floor(value)).cast("long")


def day_of(second: Column, zone: str = "UTC") -> Column:
    """Local calendar day of an epoch second, as ``yyyy-MM-dd``."""
    return F.date_format(F.from_utc_timestamp(F.timestamp_seconds(second), zone), "yyyy-MM-dd")


def day_start(day: Column, zone: str) -> Column:
    return F.unix_timestamp(F.to_utc_timestamp(day.cast("timestamp"), zone))


def day_bounds(ranges: DataFrame, zone: str = "UTC") -> DataFrame:
    """(day, start, end) tiles of the local days of each (start, end); empty ranges have none.

    Days with a clock change are shorter or longer. The session's zone is taken to be UTC.
    """
    some = ranges.select("start", "end").where(F.col("end") > F.col("start"))
    local = lambda s: F.to_date(F.from_utc_timestamp(F.timestamp_seconds(s), zone))
    days = some.withColumn("_day", F.explode(F.sequence(local(F.col("start")), local(F.col("end") - 1))))
    return days.select(
        F.date_format("_day", "yyyy-MM-dd").alias("day"),
        F.greatest("start", day_start(F.col("_day"), zone)).alias("start"),
        F.least("end", day_start(F.date_add("_day", 1), zone)).alias("end"),
    )


def bisect(start: Column, end: Column) -> Column:
    """The two halves of a range as an array of (start, end); ranges under 2 seconds are an error."""
    middle = start + F.floor((end - start) / 2).cast("long")
    halves = F.array(F.struct(start.alias("start"), middle.alias("end")), F.struct(middle.alias("start"), end.alias("end")))
    return F.when(end - start >= 2, halves).otherwise(F.raise_error(F.lit("range is too short to split")))


def next_span(current: int, least: int) -> int | None:
    """The first span of the ladder below ``current`` that is not below ``least``."""
    return next((s for s in SPAN_LADDER if least <= s < current), None)


def initial_span(start: int, end: int, requested: int) -> int:
    """``requested``, or the first coarser span with which the range has at most MAX_BINS bins.

    Coarser spans are those of the ladder, and behind it the last span times 4, 16 and so on.
    """
    # The range has at most MAX_BINS bins if a span is longer than this.
    too_short = (end - start) // (MAX_BINS + 1)
    if requested > too_short:
        return requested
    coarser = [s for s in reversed(SPAN_LADDER) if s > max(requested, too_short)]
    if coarser:
        return coarser[0]
    longest = max(requested, SPAN_LADDER[0])
    return longest * 4 ** next(k for k in range(1, 40) if longest * 4**k > too_short)


def format_time(second: Column) -> Column:
    return F.date_format(F.timestamp_seconds(second), "yyyy-MM-dd'T'HH:mm:ss.SSSxxx")


def chunk_path(day: Column, start: Column, end: Column, kind: str = "jsonl") -> Column:
    return F.concat(day, F.lit("/"), start.cast("string"), F.lit("-"), end.cast("string"), F.lit(f".{kind}.gz"))


def check_range(earliest: int, latest: int) -> None:
    if latest <= earliest:
        raise ValueError("the range's end must be later than its start")
