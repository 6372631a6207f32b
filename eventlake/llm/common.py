"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of ids is broadcast only after its rows were counted and are at most this many.
BROADCAST_ROWS = 1_000_000

#: Words of a text as a Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Where none is set, a local session, as in tests, gets a temporary one; elsewhere, executors would not see it.
    """
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not re.fullmatch(r"local(\[.*)?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", place)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(place)
    return place


def new_dir(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder, so that lost executors lose no rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a side of a join for broadcasting if its counted rows are few; else it is shuffled."""
    return F.broadcast(df) if rows <= limit else df


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def parallelism(spark: SparkSession) -> int:
    """Partitions of a shuffle in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
