"""Pages of chunks in blocks: a page is found from its number, and the file of its block is opened for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.names import free_names
from eventlake.operators.chunks import paginate

PAGES_OF_BLOCK = 64


def write_pages(assigned: DataFrame, path: str, size: int, order: list[str], pages_of_block: int = PAGES_OF_BLOCK) -> None:
    """Events with their chunk as pages of ``size`` rows in ``order``; the blocks of pages are dealt to files by hash.

    A block lies in one file, in order, so no task or file holds a whole chunk. The number of files follows the rows that
    Spark puts into a task, not the number of blocks. An index beside them has the rows and pages of each chunk, and the
    file of each block. ``order`` begins with the column of the time, and must be an order without ties for pages to be the
    same each time.
    """
    paged = paginate(assigned, size, order)
    (block,) = free_names("block", beside=[paged])
    placed = paged.withColumn(block, F.floor(F.col("page") / pages_of_block)).repartition("chunk_start", block)
    placed.sortWithinPartitions("chunk_start", "page", *order).drop(block).write.parquet(f"{path}/blocks")
    written = assigned.sparkSession.read.schema(paged.schema).parquet(f"{path}/blocks")
    at = F.floor(F.col("page") / pages_of_block).alias("block")
    blocks = written.groupBy("chunk_start", "chunk_end", at, F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"))
    blocks.repartitionByRange("chunk_start", "block").sortWithinPartitions("chunk_start", "block").write.parquet(f"{path}/files")
    counts = assigned.sparkSession.read.parquet(f"{path}/files").groupBy("chunk_start", "chunk_end").agg(F.sum("rows").alias("rows"))
    facts = {"pages": F.ceil(F.col("rows") / size), "size": F.lit(size), "pages_of_block": F.lit(pages_of_block), "order": F.lit(",".join(order))}
    counts.withColumns(facts).write.parquet(f"{path}/index")


def page_index(spark: SparkSession, path: str) -> DataFrame:
    """chunk_start, chunk_end, rows and pages of each chunk that has rows."""
    return spark.read.parquet(f"{path}/index").select("chunk_start", "chunk_end", "rows", "pages")


def read_page(spark: SparkSession, path: str, chunk_start: int, page: int) -> DataFrame:
    """The rows of one page, in order; an error if the chunk has no such page.

    Only its block's file is opened. That is sorted by chunk and page, so Parquet skips most of what is not asked for.
    """
    found = spark.read.parquet(f"{path}/index").where(F.col("chunk_start") == chunk_start).collect()
    if not found or not 0 <= page < found[0]["pages"]:
        raise ValueError(f"chunk {chunk_start} has no page {page}")
    one = found[0]
    here = (F.col("chunk_start") == chunk_start) & (F.col("block") == page // one["pages_of_block"])
    files = [f"{path}/blocks/{r['file']}" for r in spark.read.parquet(f"{path}/files").where(here).select("file").distinct().collect()]
    return spark.read.parquet(*files).where((F.col("chunk_start") == chunk_start) & (F.col("page") == page)).orderBy(*one["order"].split(","))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all pages of all chunks."""
    return spark.read.parquet(f"{path}/blocks")
