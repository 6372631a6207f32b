"""Distinct keys of any range of days from stored sketches, with a bound on their error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers of a sketch, as a power of two: 16 KB a day.
LOG_REGISTERS = 14
#: Relative error of an estimate, as a standard deviation, and how many of these the bound allows.
ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)
DEVIATIONS = 4


def day_sketches(events: DataFrame, keys: list[str], day: Column) -> DataFrame:
    """day, rows and sketch: one row a day, made with map-side sketches; a key of nulls counts as a key."""
    return events.groupBy(day.alias("day")).agg(F.count("*").alias("rows"), F.hll_sketch_agg(F.xxhash64(*keys), LOG_REGISTERS).alias("sketch"))


def merge_sketches(old: DataFrame, new: DataFrame) -> DataFrame:
    """Days of both tables; a day that both have counts its keys once."""
    both = old.unionByName(new)
    return both.groupBy("day").agg(F.sum("rows").alias("rows"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_keys(sketches: DataFrame, ranges: DataFrame) -> DataFrame:
    """rows, keys, least and most of each range (id, first, last; both days included): an estimate and its bounds.

    Ranges are few beside events: each takes one small row a day.
    """
    inside = ranges.join(sketches, (F.col("day") >= F.col("first")) & (F.col("day") <= F.col("last")))
    merged = inside.groupBy("id").agg(F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("keys"))
    margin = F.ceil(F.col("keys") * ERROR * DEVIATIONS) + 1
    bounded = merged.select("id", "rows", "keys", (F.col("keys") - margin).alias("least"), F.least("rows", F.col("keys") + margin).alias("most"))
    none = F.lit(0).cast("long")
    return ranges.join(bounded, "id", "left").select("id", *[F.coalesce(c, none).alias(c) for c in ("rows", "keys", "least", "most")])
