"""Counts of a growing table for any range and pin, and plans that follow its growth, without scans of the events.

A tree has counts by (span, start, index bucket) for the spans of the ladder, each of which divides the one before. It is
stored as it grows: each batch of events that were indexed since the last adds its own counts, in a folder of its own, so a
batch that is run again replaces itself. A range is covered by at most a few dozen nodes and whole days; each node has
running sums over its index buckets, so that a pin is answered by one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.times import SPAN_LADDER
from eventlake.operators.chunks import small
from eventlake.operators.planning import pack, refine_seconds

TREE = "start long, bucket long, n long, batch string, span int"


def grow(events: DataFrame, path: str, batch: str, bucket: int) -> None:
    """Add the counts of a batch of events (t, _indextime) to the tree below ``path``; the batch's name makes it repeatable.

    ``bucket`` is the length of index buckets in seconds, the same for all batches; pins are multiples of it.
    """
    at = (F.floor(F.col("_indextime") / bucket) * bucket).cast("long")
    # One shuffle of the events, with counts made before it; coarser levels are sums of these.
    cells = events.groupBy(F.col("t").cast("long").alias("t"), at.alias("bucket")).agg(F.count("*").alias("n"))
    nodes = F.array(*[F.struct(F.lit(s).alias("span"), (F.floor(F.col("t") / s) * s).cast("long").alias("start")) for s in SPAN_LADDER])
    levels = cells.select(F.explode(nodes).alias("x"), "bucket", "n").groupBy("x.span", "x.start", "bucket").agg(F.sum("n").alias("n"))
    levels.select("start", "bucket", "n", "span").repartition("span", F.floor(F.col("start") / SPAN_LADDER[0])).sortWithinPartitions("span", "start").write.mode(
        "overwrite"
    ).partitionBy("span").parquet(f"{path.rstrip('/')}/batch={batch}")


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TREE).parquet(path)


def cover(ranges: DataFrame) -> DataFrame:
    """The ranges (start, end and more) with the nodes that tile each: columns of ``ranges``, span and node.

    The coarsest nodes that fit lie inside; on both sides of them, ever finer ones.
    """
    up = lambda x, s: (F.ceil(x / s) * s).cast("long")
    down = lambda x, s: (F.floor(x / s) * s).cast("long")
    start, end = F.col("start"), F.col("end")
    none = F.array().cast("array<struct<span:int,node:bigint>>")

    def tiles(a: Column, b: Column, s: int) -> Column:
        run = F.transform(F.sequence(a, b - s, F.lit(s).cast("long")), lambda x: F.struct(F.lit(s).alias("span"), x.alias("node")))
        return F.when(a < b, run).otherwise(none)

    parts, inner = [], None
    for s in SPAN_LADDER:
        a, b = up(start, s), down(end, s)
        if inner is None:
            parts.append(tiles(a, b, s))
        else:
            left, right = inner
            empty = left >= right
            parts.append(F.when(empty, tiles(a, b, s)).otherwise(F.concat(tiles(a, left, s), tiles(right, b, s))))
        inner = (a, b)
    return ranges.where(start < end).select(*ranges.columns, F.explode(F.concat(*parts)).alias("x")).select(*ranges.columns, "x.span", "x.node")


def prefixes(tree: DataFrame) -> DataFrame:
    """span, start, upto: running sums over the index buckets of each node, as (bucket, n) in order."""
    sums = tree.groupBy("span", "start", "bucket").agg(F.sum("n").alias("n"))
    nodes = sums.groupBy("span", "start").agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("b"))
    first = F.struct(F.lit(0).cast("long").alias("n"), F.array().cast("array<struct<bucket:bigint,n:bigint>>").alias("upto"))
    run = F.aggregate(
        "b", first, lambda acc, x: F.struct((acc["n"] + x["n"]).alias("n"), F.concat(acc["upto"], F.array(F.struct(x["bucket"], (acc["n"] + x["n"]).alias("n")))).alias("upto"))
    )
    return nodes.select("span", "start", run["upto"].alias("upto"))


def counts_at(sums: DataFrame, questions: DataFrame, bucket: int) -> DataFrame:
    """n and late for each question (id, start, end, pin, old_pin): events of the range under the pin, and those since the old pin.

    ``sums`` are :func:`prefixes`. A null pin counts all, a null old pin none as late. Pins that are no multiples of ``bucket`` are an error.
    """
    off = questions.where(f"pin % {int(bucket)} <> 0 OR old_pin % {int(bucket)} <> 0").limit(1).collect()
    if off:
        raise ValueError(f"pins must be multiples of {bucket}: {off[0]}")
    nodes = cover(questions.select("id", "start", "end", "pin", "old_pin"))
    nodes = small(nodes, nodes.count())

    def under(pin: Column) -> Column:
        # The last running sum of a bucket before the pin.
        sums_ = F.filter("upto", lambda x: F.coalesce(x["bucket"] < pin, F.lit(True)))
        return F.coalesce(F.try_element_at(sums_, F.lit(-1))["n"], F.lit(0))

    known = sums.withColumnRenamed("start", "node").join(nodes, ["span", "node"])
    late = F.when(F.col("old_pin").isNull(), 0).otherwise(under(F.col("pin")) - under(F.col("old_pin")))
    found = known.groupBy("id").agg(F.sum(under(F.col("pin"))).alias("n"), F.sum(late).alias("late"))
    none = F.lit(0).cast("long")
    return questions.join(found, "id", "left").select(*questions.columns, F.coalesce("n", none).alias("n"), F.coalesce("late", none).alias("late"))


def seconds_of(tree: DataFrame, pin: int | None = None) -> DataFrame:
    """(t, n) of the events under a pin."""
    inside = tree.where("span = 1") if pin is None else tree.where("span = 1").where(F.col("bucket") < pin)
    return inside.groupBy(F.col("start").alias("t")).agg(F.sum("n").alias("n"))


def touched_bins(added: DataFrame, start: int, end: int, span: int) -> DataFrame:
    """``top``: the bins of the first span that a batch (rows of the tree) adds events to."""
    t = added.where("span = 1").where((F.col("start") >= start) & (F.col("start") < end)).select(F.col("start").alias("t"))
    return t.select((F.floor(F.col("t") / span) * span).cast("long").alias("top")).distinct()


def refine_again(bins: DataFrame, tree: DataFrame, added: DataFrame, start: int, end: int, span: int, target: int, least: int = 1, pin: int | None = None) -> DataFrame:
    """Bins after a batch: those of first-span bins that it touches are refined from the tree, others stay as they are.

    Equal to refining all of it anew.
    """
    tops = touched_bins(added, start, end, span)
    tops = small(tops, tops.count())
    top = lambda c: (F.floor(F.col(c) / span) * span).cast("long")
    some = seconds_of(tree.withColumn("top", top("start")).join(tops, "top", "left_semi"), pin)
    fresh = refine_seconds(some, start, end, span, target, least)
    # The first bin may begin later than its span, at the start of the range; both fall on the same multiple.
    kept = bins.withColumn("top", top("start")).join(tops, "top", "left_anti").select("start", "end", "count")
    return kept.unionByName(fresh.select("start", "end", "count"))


def pack_again(plan: DataFrame, bins: DataFrame, added: DataFrame, start: int, end: int, target: int) -> DataFrame:
    """The plan after a batch: only days that it touches are packed again (days of UTC; bins no longer than a day)."""
    spark = plan.sparkSession
    ranges = spark.range(1).select(F.lit(start).cast("long").alias("start"), F.lit(end).cast("long").alias("end"))
    at = F.floor(F.col("start") / SPAN_LADDER[0])
    days = added.where("span = 1").where((F.col("start") >= start) & (F.col("start") < end)).select(at.alias("at")).distinct()
    days = small(days, days.count())
    name = days.select(F.date_format(F.timestamp_seconds(F.col("at") * SPAN_LADDER[0]), "yyyy-MM-dd").alias("day"))
    some = bins.withColumn("at", at).join(days, "at", "left_semi").drop("at")
    fresh = pack(some, ranges, target, only=name)
    return plan.join(name, "day", "left_anti").unionByName(fresh.select(*plan.columns))
