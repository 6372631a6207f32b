"""Decoding of bytes that may be invalid, and encoding of rows as lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_FIELDS = ["_time", "_raw", "index", "sourcetype", "source", "host", "_indextime", "_bkt", "_cd"]


def decode_tolerant(raw: Column) -> Column:
    """(text, replaced): UTF-8 with U+FFFD for invalid sequences, and how many of those were put in."""
    text = F.make_valid_utf8(raw.cast("string"))
    mark = "�"
    after = F.length(text) - F.length(F.replace(text, F.lit(mark)))
    plain = F.decode(raw, "ISO-8859-1")
    before = F.length(plain) - F.length(F.replace(plain, F.lit("ï¿½")))
    return F.struct(text.alias("text"), (after - F.floor(before / 3)).cast("long").alias("replaced"))


def extra_lines(raw: Column) -> Column:
    """Line breaks inside a raw event: physical lines beyond the first."""
    return F.coalesce(F.length(raw) - F.length(F.replace(raw, F.lit("\n"))), F.lit(0)).cast("long")


def select_fields(df: DataFrame, fields: list[str] | None) -> DataFrame:
    """The listed fields that exist, in the listed order; all if none are listed."""
    return df.select(*[f for f in fields if f in df.columns]) if fields else df


def default_fields(whole_set: bool, requested: list[str] | None, kind: str) -> list[str] | None:
    """Fields to extract; None means all. Raw output needs the raw event."""
    if requested is None and whole_set:
        return None
    fields = list(DEFAULT_FIELDS if requested is None else requested)
    return fields + ["_raw"] if kind == "raw" and "_raw" not in fields else fields


def encode_json(df: DataFrame, fields: list[str] | None = None) -> Column:
    """One compact JSON object for each row; null fields are left out."""
    names = [f for f in (fields or df.columns) if f in df.columns]
    return F.to_json(F.struct(*names))


def encode_raw(raw: Column) -> Column:
    return F.coalesce(raw, F.lit(""))


def line_digest(lines: DataFrame, keys: list[str], line: str = "line") -> DataFrame:
    """Rows, and order-insensitive sums of line hashes, for each key; two differ if contents do."""
    h = F.xxhash64(line)
    return lines.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor(h).alias("hash_xor")
    )


#: Lines of one key that are sorted in one task, at most, on average.
DIGEST_LINES = 100_000


def sorted_digest(lines: DataFrame, keys: list[str], line: str = "line", most: int = DIGEST_LINES) -> DataFrame:
    """Rows and a digest of the multiset of lines of each key.

    Equal lines are counted first. Up to ``most`` lines, the digest is the SHA-256 over the byte-sorted lines,
    each with its break. A larger key is dealt to blocks by the hash of the line; its digest is the SHA-256 over
    the digests of the blocks in order, whose lines are followed by a tab and their count instead of being repeated.
    """
    counted = lines.groupBy(*keys, F.col(line).alias("_line")).agg(F.count("*").alias("_n"))
    sizes = counted.groupBy(*keys).agg(F.sum("_n").alias("rows")).withColumn("_blocks", F.ceil(F.col("rows") / most))
    block = F.pmod(F.xxhash64("_line"), F.col("_blocks")).cast("int")
    placed = counted.join(sizes, keys).withColumn("_block", block)
    whole = F.repeat(F.concat("_line", F.lit("\n")), F.col("_n").cast("int"))
    text = F.when(F.col("_blocks") == 1, whole).otherwise(F.concat("_line", F.lit("\t"), F.col("_n").cast("string"), F.lit("\n")))
    ordered = F.array_sort(F.collect_list(F.struct(F.col("_line").cast("binary").alias("by"), text.alias("text"))))
    joined = F.array_join(F.transform(ordered, lambda x: x["text"]), "")
    digests = placed.groupBy(*keys, "rows", "_blocks", "_block").agg(F.sha2(joined.cast("binary"), 256).alias("_digest"))
    in_order = F.array_sort(F.collect_list(F.struct("_block", "_digest")))
    of_blocks = F.sha2(F.array_join(F.transform(in_order, lambda x: x["_digest"]), "\n").cast("binary"), 256)
    digest = F.when(F.col("_blocks") == 1, F.max("_digest")).otherwise(of_blocks)
    return digests.groupBy(*keys, "rows", "_blocks").agg(digest.alias("digest")).select(*keys, "rows", "digest")
