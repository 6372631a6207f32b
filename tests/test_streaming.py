from pyspark.sql import functions as F

from eventlake.operators.planning import histogram
from eventlake.sources.events import epoch, events_view
from eventlake.streaming import live

SF = "/root/testdata/sf0.001"


def _parts(spark, tmp_path, n=3):
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    path = str(tmp_path / "in")
    for i in range(n):
        events.where(F.col("event_id") % n == i).coalesce(1).write.mode("append").parquet(path)
    return events, path


def test_extract_resumes_without_repeats(spark, tmp_path):
    events, path = _parts(spark, tmp_path)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    source = live.stream_events(spark, path, events.schema, 1)
    live.extract_stream(source, out, state).awaitTermination()
    assert spark.read.text(out).count() == events.count()
    live.extract_stream(source, out, state).awaitTermination()
    assert spark.read.text(out).count() == events.count()
    events.limit(5).coalesce(1).write.mode("append").parquet(path)
    live.extract_stream(live.stream_events(spark, path, events.schema), out, state).awaitTermination()
    assert spark.read.text(out).count() == events.count() + 5


def test_live_histogram_equals_batch(spark, tmp_path):
    events, path = _parts(spark, tmp_path, 1)
    end = events.agg(F.max("ts")).first()[0]
    late = spark.createDataFrame([(10**9, end, 1, "view", 1.0, "{}")], events.schema).withColumn("ts", F.col("ts") + F.expr("INTERVAL 3 DAYS"))
    late.write.mode("append").parquet(path)
    counts = live.live_histogram(live.stream_events(spark, path, events.schema), "1 hour", "10 minutes")
    query = counts.writeStream.format("memory").queryName("live").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = {tuple(r) for r in spark.sql("SELECT start, end, count FROM live").collect()}
    batch = events.select(epoch(F.col("ts")).alias("t"))
    assert got == {tuple(r) for r in histogram(batch, 3600, 0, 1 << 40).collect()}


def test_late_rows_are_kept_apart(spark, tmp_path):
    view = events_view(spark, SF)
    view.write.parquet(str(tmp_path / "in"))
    pin = view.agg(F.percentile_approx("_indextime", 0.7)).first()[0]
    main, delta = str(tmp_path / "main"), str(tmp_path / "delta")
    source = live.stream_events(spark, str(tmp_path / "in"), view.schema)
    query = source.writeStream.foreachBatch(live.split_late(main, delta, pin)).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    a, b = spark.read.parquet(main), spark.read.parquet(delta)
    assert a.count() + b.count() == view.count() and b.count() > 0
    assert a.where(F.col("_indextime") >= pin).count() == 0
