import pytest
from pyspark.sql import functions as F

from eventlake.operators import chunks as ch
from eventlake.operators import sketches as sk
from eventlake.sources import pages


def test_a_page_opens_one_block(spark, tmp_path):
    events = spark.range(1000).select(F.col("id").alias("event_id"), (F.col("id") / 3).cast("long").alias("t"), F.lit("x").alias("block"))
    chunks = spark.createDataFrame([("1970-01-01", 0, 200), ("1970-01-01", 200, 300), ("1970-01-01", 300, 400)], "day string, start long, end long")
    path = str(tmp_path / "p")
    pages.write_pages(ch.assign_chunks(events, chunks), path, 10, ["t", "event_id"], pages_of_block=4)
    index = {r.chunk_start: (r.rows, r.pages) for r in pages.page_index(spark, path).collect()}
    assert index == {0: (600, 60), 200: (300, 30), 300: (100, 10)}
    for start, page, first in ((0, 0, 0), (0, 59, 590), (200, 17, 770), (300, 9, 990)):
        got = pages.read_page(spark, path, start, page)
        assert [r.event_id for r in got.collect()] == list(range(first, first + 10))
        assert len(got.inputFiles()) == 1 and {r.block for r in got.collect()} == {"x"}
    for start, page in ((0, 60), (0, -1), (7, 0)):
        with pytest.raises(ValueError):
            pages.read_page(spark, path, start, page)
    assert pages.read_pages(spark, path).count() == 1000


def test_blocks_share_files(spark, tmp_path):
    events = spark.range(1200).select(F.col("id").alias("event_id"), (F.col("id") / 3).cast("long").alias("t"), F.lit("x").alias("chunk"))
    chunks = spark.createDataFrame([("1970-01-01", 0, 300), ("1970-01-01", 300, 400)], "day string, start long, end long")
    path = str(tmp_path / "p")
    pages.write_pages(ch.assign_chunks(events, chunks), path, 2, ["t", "event_id"], pages_of_block=1)
    # 600 blocks; the files are as many as the tasks.
    assert len(list((tmp_path / "p/blocks").rglob("*.parquet"))) <= 4
    assert spark.read.parquet(f"{path}/files").count() == 600
    for start, page, first in ((0, 0, 0), (0, 449, 898), (300, 0, 900), (300, 149, 1198)):
        got = pages.read_page(spark, path, start, page)
        assert [r.event_id for r in got.collect()] == [first, first + 1] and len(got.inputFiles()) == 1
    whole = pages.read_pages(spark, path)
    assert whole.count() == 1200 and whole.select("chunk").distinct().collect() == [("x",)]


def test_sketches_stay_within_their_bound(spark):
    events = spark.range(60_000).select((F.col("id") % 6).alias("day"), (F.col("id") % 37_001).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("b"))
    halves = [events.where("a % 2 = 0"), events.where("a % 2 = 1")]
    one = sk.day_sketches(events, ["a", "b"], F.col("day"))
    two = sk.merge_sketches(*[sk.day_sketches(h, ["a", "b"], F.col("day")) for h in halves])
    ranges = spark.createDataFrame([(1, 0, 0), (2, 1, 3), (3, 0, 5), (4, 9, 9)], "id long, first long, last long")
    for sketches in (one, two):
        got = {r.id: r for r in sk.distinct_keys(sketches, ranges).collect()}
        for i, a, b in ranges.collect():
            exact = events.where((F.col("day") >= a) & (F.col("day") <= b)).select("a", "b").distinct().count()
            assert got[i].least <= exact <= got[i].most and got[i].most - got[i].least < 0.08 * max(exact, 100)
    assert (got[4].rows, got[4].keys) == (0, 0) and got[3].rows == 60_000
