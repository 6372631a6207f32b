"""Where two outputs differ, by trees of digests over hash ranges of their lines.

The lines of a key fall into ``2 ** BITS`` leaves by the first bits of their hash. A leaf's digest is the SHA-256 over its
different lines in byte order, each with how often it occurs; a node's is that over the digests of its children. The root
is a digest of the whole multiset with one definition at every size, whatever order, files or partitions lines come in.

Trees are small beside lines and can be stored with an output. Two of them are compared from the root on, and only
children of nodes that differ are looked at; only lines of leaves that differ are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.operators.chunks import small
from eventlake.sources.sinks import keep

#: Bits of the hash that name a leaf, and those by which a level is finer than the one above.
BITS, FAN_BITS = 16, 4
LEVELS = BITS // FAN_BITS


def leaf_of(line: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(line), 64 - BITS).cast("int")


def _joined(rows: Column) -> Column:
    return F.sha2(F.array_join(F.transform(F.array_sort(rows), lambda x: x["text"]), "\n").cast("binary"), 256)


def digest_tree(lines: DataFrame, keys: list[str], line: str = "line") -> DataFrame:
    """keys, level (0 is the root), node, rows and digest of the lines of each key; a null line is an empty one."""
    text = lines.select(*keys, F.coalesce(F.col(line), F.lit("")).alias("x"))
    counted = text.groupBy(*keys, "x").agg(F.count("*").alias("n"))
    one = F.struct(F.col("x").cast("binary").alias("by"), F.concat("x", F.lit("\t"), F.col("n").cast("string")).alias("text"))
    level = counted.groupBy(*keys, leaf_of(F.col("x")).alias("node")).agg(F.sum("n").alias("rows"), _joined(F.collect_list(one)).alias("digest"))
    level = keep(level, "leaves")
    tree = level.withColumn("level", F.lit(LEVELS))
    for depth in range(LEVELS - 1, -1, -1):
        child = F.struct(F.col("node").alias("by"), F.concat(F.col("node").cast("string"), F.lit(":"), "digest").alias("text"))
        level = level.groupBy(*keys, F.shiftright("node", FAN_BITS).alias("node")).agg(F.sum("rows").alias("rows"), _joined(F.collect_list(child)).alias("digest"))
        tree = tree.unionByName(level.withColumn("level", F.lit(depth)))
    return tree.select(*keys, "level", "node", "rows", "digest")


def root_digests(tree: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rows and digest: one row for each key that has lines."""
    return tree.where("level = 0").select(*keys, "rows", "digest")


def store_tree(tree: DataFrame, path: str) -> None:
    """By level, so that a comparison reads the levels that it reaches."""
    tree.write.partitionBy("level").parquet(path)


def different_leaves(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """keys and node of the leaves in which two trees differ, descending only below nodes that differ."""
    front = None
    for depth in range(LEVELS + 1):
        sides = []
        for tree, name in ((a, "a"), (b, "b")):
            level = tree.where(F.col("level") == depth).select(*keys, "node", F.col("digest").alias(name))
            if front is not None:
                above = small(front, front.count())
                level = level.withColumn("above", F.shiftright("node", FAN_BITS)).join(above, [*keys, "above"], "left_semi").drop("above")
            sides.append(level)
        off = sides[0].join(sides[1], [*keys, "node"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(*keys, "node")
        found = keep(off, "front")
        front = found.withColumnRenamed("node", "above")
    return found


def different_lines(a: DataFrame, b: DataFrame, leaves: DataFrame, keys: list[str], line: str = "line") -> DataFrame:
    """keys, line and off (how much more often the line is in ``a`` than in ``b``), of the leaves that differ."""
    few = small(leaves, leaves.count())
    parts = []
    for lines, sign in ((a, 1), (b, -1)):
        text = lines.select(*keys, F.coalesce(F.col(line), F.lit("")).alias(line))
        parts.append(text.withColumn("node", leaf_of(F.col(line))).join(few, [*keys, "node"], "left_semi").withColumn("sign", F.lit(sign)))
    off = parts[0].unionByName(parts[1]).groupBy(*keys, line).agg(F.sum("sign").alias("off"))
    return off.where("off <> 0")
