"""Operator 2: mixing sources to target weights with hash-threshold histograms.

Each source has a target number of words. A source whose target is ``r`` times its size takes every
document ``floor(r)`` times, and once more those documents whose 60-bit hash lies below the source's
threshold. The threshold is found without sorting documents: words are summed by source and hash
bucket, the bucket that the budget ends in is found by a running sum over buckets, and only the
documents of that bucket are summed again by finer buckets, until the boundary is a single hash
value. Thresholds are nested: a larger budget takes a superset of the documents.

Defined results:
* a null or empty text has size 0; such a document is taken 0 words;
* a null source is a source of its own and comes last; the empty text is an ordinary source;
* rows with equal id and text have equal hashes, and are taken or left together;
* an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm.common import WORD, cut, small, table

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
#: The hash is read in steps of so many hexadecimal digits.
STEP_DIGITS = 3
HASH_DIGITS = 15


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_digits(doc_id: Column, text: Column) -> Column:
    """60 bits as fixed-width hexadecimal text, in the order of the numbers."""
    key = F.concat_ws(" ", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.substring(F.md5(key.cast("binary")), 1, HASH_DIGITS)


def running(df: DataFrame, order: list[Column], columns: list[str]) -> DataFrame:
    """``df`` with ``place`` (from 1) in the order and, for each column, ``before_``: its sum over all rows before.

    Rows are dealt by ranges of the order; sums over whole ranges come from one row for each of them, so no task
    sees all rows. The order must have no ties.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("part").orderBy(*order)
    sums = ranged.groupBy("part").agg(F.count("*").alias("rows"), *[F.sum(c).alias(c) for c in columns])
    sums = sums.select("part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"parts_{c}") for c in ("rows", *columns)])
    placed = ranged.join(F.broadcast(sums), "part").withColumn("place", F.col("parts_rows") + F.row_number().over(within))  # one row a partition
    inside = within.rowsBetween(Window.unboundedPreceding, -1)
    for c in columns:
        placed = placed.withColumn(f"before_{c}", F.col(f"parts_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)))
    return placed.drop("part", "parts_rows", *[f"parts_{c}" for c in columns])


def water_levels(by_source: DataFrame) -> DataFrame:
    """Targets of sources: shares by weight, none above MOST_COPIES times its size.

    Sharing a source's excess again and again by weight ends at a common level: every source gets
    the smaller of its limit and level x weight. Sources sorted by limit / weight fill up in that
    order, so running sums give the level.
    """
    by_name = F.col("source").asc_nulls_last()
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (((F.col("place") - 1) % len(WEIGHTS)) + 1).cast("int"))
    ranked = (
        running(by_source, [by_name], [])
        .withColumn("weight", weight.cast("double"))
        .withColumn("top", F.col("source_size") * float(MOST_COPIES))
        .withColumn("fill_at", F.col("top") / F.col("weight"))
        .drop("place")
    )
    filled = cut(running(ranked, [F.col("fill_at"), by_name], ["top", "weight"]))
    sums = filled.agg(F.sum("source_size").cast("double").alias("total"), F.sum("weight").alias("weights")).first()
    level = (F.lit(sums["total"]) - F.col("before_top")) / (F.lit(sums["weights"]) - F.col("before_weight"))
    # The level holds from the first source on that it does not fill.
    first = filled.select("place", "fill_at", level.alias("level")).where("level <= fill_at").agg(F.min_by("level", "place")).first()[0]
    target = F.least(F.col("top"), F.lit(first or 0.0) * F.col("weight"))
    return filled.select("source", "source_size", target.alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, copies, below): documents with a hash of at most ``below`` get one copy more."""
    budgets = targets.where("source_size > 0").select(
        "source",
        F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST_COPIES)).alias("copies"),
        F.col("target").alias("goal"),
        "source_size",
    )
    sources = targets.count()
    open_ = budgets.select(
        "source", "copies", (F.col("goal") - F.col("copies") * F.col("source_size")).alias("budget"), F.lit("").alias("below")
    )
    for at in range(1, HASH_DIGITS + 1, STEP_DIGITS):
        prefix = F.substring("h", 1, at - 1)
        inside = sized.join(small(open_.withColumnRenamed("source", "s"), sources), F.col("source").eqNullSafe(F.col("s")) & (prefix == F.col("below")))
        sums = inside.groupBy("source", "copies", "budget", F.substring("h", 1, at + STEP_DIGITS - 1).alias("bucket")).agg(
            F.sum("size").alias("words")
        )
        up = Window.partitionBy("source").orderBy("bucket")
        run = sums.withColumn("upto", F.sum("words").over(up))
        # The boundary: the first bucket that reaches the budget, else the last one.
        edge = run.groupBy("source", "copies").agg(
            F.min(F.when(F.col("upto") >= F.col("budget"), F.struct("bucket", "upto", "words", "budget"))).alias("reach"),
            F.max(F.struct("bucket", "upto", "words", "budget")).alias("last"),
        )
        edge = edge.select("source", "copies", F.coalesce("reach", "last").alias("e"))
        open_ = cut(
            edge.select(
                "source",
                "copies",
                (F.col("e.budget") - F.col("e.upto") + F.col("e.words")).alias("budget"),
                F.col("e.bucket").alias("below"),
                F.col("e.words").alias("edge_words"),
            )
        )
        if at + STEP_DIGITS <= HASH_DIGITS:
            open_ = open_.drop("edge_words")
    # One hash value is left at the boundary: it is taken if that comes nearer to the budget.
    take = F.col("budget") * 2 >= F.col("edge_words")
    return open_.select("source", "copies", "below", take.alias("edge_too"))


def plan_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents with size and hash, the plan: one row for each source)."""
    sized = cut(
        docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), hash_digits(F.col("doc_id"), F.col("text")).alias("h"))
    )
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut(water_levels(by_source))
    edges = thresholds(sized.where("size > 0"), targets)
    plan = targets.alias("t").join(edges.alias("e"), F.col("t.source").eqNullSafe(F.col("e.source")), "left").select(
        F.col("t.source").alias("s"), "source_size", "target", "copies", "below", "edge_too"
    )
    return sized, cut(plan)


def _copies(size: Column) -> Column:
    """How often the plan takes a document of this size and hash ``h``."""
    extra = (F.col("h") < F.col("below")) | ((F.col("h") == F.col("below")) & F.col("edge_too"))
    copies = F.least(F.coalesce(F.col("copies") + F.when(extra, 1).otherwise(0), F.lit(0)), F.lit(MOST_COPIES))
    return F.when(size > 0, copies).otherwise(0).cast("int")


def mix(docs: DataFrame) -> DataFrame:
    """Documents with size, source_size, target and copies (how often the mix takes each)."""
    sized, plan = plan_of(docs)
    return sized.join(small(plan, plan.count()), F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "h", "size", "source_size", "target", _copies(F.col("size")).alias("copies")
    )


def apply_mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it.

    A filter by threshold: each row is decided by its own source's row of the plan while it is read.
    """
    _, plan = plan_of(docs)
    keyed = docs.select(
        F.struct("*").alias("row"),
        F.col("source").alias("from"),
        n_words(F.col("text")).alias("words"),
        hash_digits(F.col("doc_id"), F.col("text")).alias("h"),
    )
    picked = keyed.join(small(plan, plan.count()), F.col("from").eqNullSafe(F.col("s")))
    taken = picked.select("row", _copies(F.col("words")).alias("n")).where("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^ \t-\r]+')), 0)::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '') || ' ' || md5(coalesce(text, ''))), 1, 15) AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS weight FROM s),
c AS (SELECT *, source_size * 3.0::DOUBLE AS top, source_size * 3.0::DOUBLE / weight AS fill_at FROM w),
l AS (SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(top) OVER b, 0)) /
                ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER b, 0)) AS level,
             row_number() OVER (ORDER BY fill_at, source NULLS LAST) AS place
      FROM c WINDOW b AS (ORDER BY fill_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
             least(top, coalesce((SELECT arg_min(level, place) FROM l WHERE level <= fill_at), 0) * weight)::DOUBLE AS target FROM l),
x AS (SELECT d.*, t.source_size, t.target,
             least(floor(t.target / nullif(t.source_size, 0)), 3)::BIGINT AS copies
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (SELECT *, target - copies * source_size AS budget,
             sum(size) OVER (PARTITION BY source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
             sum(size) OVER (PARTITION BY source, h) AS edge
      FROM x)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE least(copies + CASE
         WHEN upto < budget THEN 1
         WHEN upto - edge < budget OR upto = edge THEN CASE WHEN (budget - (upto - edge)) * 2 >= edge THEN 1 ELSE 0 END
         ELSE 0 END, 3) * size END::BIGINT AS taken
FROM r
"""
