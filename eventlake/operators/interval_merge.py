"""Events and chunks by a merge of intervals: one shuffle by ranges of time, one sort, one pass.

The hash form of :func:`~eventlake.operators.chunks.assign_chunks` lists chunks by hour and compares an event with all chunks
of its hour. Here events and chunk edges are dealt to parts by the same sampled bounds and sorted together; each event
then belongs to the last chunk that began before it, which a running window carries along in one pass. No side is
broadcast, and a second or an hour that holds many events is spread over as many parts as its share of the rows asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from eventlake.functions.names import refuse_names

#: Parts for each partition of a shuffle, so that parts that meet in one partition even out.
PARTS_EACH = 4
#: Bounds lie within one of so many parts of the rows.
ACCURACY = 10_000


def bounds_of(events: DataFrame, parts: int) -> list[int]:
    """Bounds of equal shares of the events by time; a second with several shares is there several times."""
    if parts < 2:
        return []
    shares = [k / parts for k in range(1, parts)]
    return list(events.where("t IS NOT NULL").agg(F.percentile_approx("t", shares, F.lit(ACCURACY)).alias("b")).first()[0] or [])


def _below(value: Column, bounds: list[int], equal: bool) -> Column:
    """How many bounds lie below a value (or at it), by halving: a few comparisons for each row."""
    if not bounds:
        return F.lit(0)
    listed = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    at = lambda place: F.get(listed, place - 1)
    before = (lambda b: b <= value) if equal else (lambda b: b < value)
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda acc, s: F.when(before(at(acc + s)), acc + s).otherwise(acc))


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, (MapType, VariantType)):
        return False
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    return all(_hashable(f.dataType) for f in kind.fields) if isinstance(kind, StructType) else True


def merge_chunks(events: DataFrame, chunks: DataFrame, keys: tuple[str, ...] = ("start", "end"), parts: int | None = None) -> DataFrame:
    """Events with the chunk they fall in, as columns ``chunk_...``: the rows of ``assign_chunks``.

    Chunks must not overlap; they may cross days. Events before, between and behind chunks, and without a time, have none and
    are left out. Events may have columns of any name but those of the chunk.
    """
    named = [f"chunk_{k}" for k in dict.fromkeys((*keys, "start", "end", "day"))]
    refuse_names(events, named)
    parts = parts or PARTS_EACH * int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = bounds_of(events, parts)
    t = F.col("t").cast("long")
    low, high = _below(t, bounds, False), _below(t, bounds, True)
    mixed = F.xxhash64(*[f.name for f in events.schema.fields if _hashable(f.dataType)])
    dealt = F.when(low == high, low).otherwise(low + F.pmod(mixed, high - low + 1).cast("int"))
    row, chunk = F.struct("*").alias("row"), F.struct(*[F.col(k[6:]).alias(k) for k in named]).alias("chunk")
    left = events.where("t IS NOT NULL").select(dealt.alias("part"), t.alias("at"), F.lit(1).alias("kind"), row)
    wide = chunks.where(F.col("start") < F.col("end")).select("start", "end", chunk)
    touched = F.sequence(_below(F.col("start"), bounds, False), _below(F.col("end") - 1, bounds, True))
    right = wide.select(F.explode(touched).alias("part"), F.col("start").cast("long").alias("at"), F.lit(0).alias("kind"), "chunk")
    both = left.unionByName(right, allowMissingColumns=True)
    # From the first row on, so the window keeps one chunk and no rows.
    so_far = Window.partitionBy("part").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = both.withColumn("chunk", F.last("chunk", ignorenulls=True).over(so_far)).where("kind = 1 AND at < chunk.chunk_end")
    return merged.select("row.*", "chunk.*")
