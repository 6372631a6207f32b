import pytest
from pyspark.sql import functions as F

from eventlake.functions.encoding import encode_json
from eventlake.operators import chunks as ch
from eventlake.sources import events as ev
from eventlake.sources import sinks

D = 1534723200


@pytest.fixture
def assigned(spark):
    rows = [(i, D + i * 3600, None if i == 7 else f"raw {i}\rx" + ("\nmore" if i % 5 == 0 else ""), "h") for i in range(40)]
    events = spark.createDataFrame(rows, "event_id long, t long, _raw string, host string")
    chunks = spark.createDataFrame([("2018-08-20", D, D + 43200), ("2018-08-20", D + 43200, D + 86400), ("2018-08-21", D + 86400, D + 172800)], "day string, start long, end long")
    return ch.assign_chunks(events, chunks), chunks


def test_ndjson_round_trip(spark, assigned, tmp_path):
    rows, _ = assigned
    sinks.write_ndjson(rows, str(tmp_path / "o"), ["t", "_raw", "missing"])
    lines = sinks.read_extracted(spark, str(tmp_path / "o"))
    expected = rows.select(encode_json(rows, ["t", "_raw"]).alias("line"))
    assert ch.same_content(lines.select("line"), expected).count() == 0
    stats = {r.chunk: r.lines for r in sinks.file_stats(lines, "chunk").collect()}
    assert stats == {f"{D}-{D + 43200}": 12, f"{D + 43200}-{D + 86400}": 12, f"{D + 86400}-{D + 172800}": 16}


def test_raw_lines_and_compaction(spark, assigned, tmp_path):
    rows, chunks = assigned
    sinks.write_raw(rows, str(tmp_path / "o"))
    lines = sinks.read_extracted(spark, str(tmp_path / "o"))
    assert lines.count() == 48 and lines.where("line = ''").count() == 1
    written = sinks.written_counts(rows)
    done = chunks.join(written, F.col("start") == F.col("chunk_start")).withColumn("status", F.lit("done"))
    days = sinks.compact_days(spark, str(tmp_path / "o"), str(tmp_path / "d"), done)
    assert sorted(tuple(r) for r in days.collect()) == [("2018-08-20", 29), ("2018-08-21", 19)]
    again = sinks.compact_days(spark, str(tmp_path / "o"), str(tmp_path / "d"), done)
    assert again.agg(F.sum("lines")).first()[0] == 48
    with pytest.raises(ValueError, match="not every chunk"):
        sinks.compact_days(spark, str(tmp_path / "o"), str(tmp_path / "d"), done.withColumn("status", F.lit("pending")))
    with pytest.raises(ValueError, match="line counts differ"):
        sinks.compact_days(spark, str(tmp_path / "o"), str(tmp_path / "d"), done.withColumn("written", F.col("written") + 1))
    first = [r.line for r in sinks.head(lines, 3).collect()]
    assert len(first) == 3


def test_export_stream(spark, tmp_path):
    good = b'{"preview":false,"offset":0,"result":{"_raw":"bad \xff\xfe"},"lastrow":true}\n\n'
    cut = b'{"preview":true,"result":{"_raw":"p"},"lastrow":true}\n{"preview":false,"result":{"_raw":"x"}}'
    (tmp_path / "a").mkdir()
    (tmp_path / "a/good.json").write_bytes(good)
    (tmp_path / "a/cut.json").write_bytes(cut)
    envelopes = ev.read_export_stream(spark, str(tmp_path / "a")).withColumn("stream", F.element_at(F.split("stream", "/"), -1))
    rows = {r.stream: (r.result["_raw"], r.replaced) for r in ev.export_rows(envelopes).collect()}
    assert rows == {"good.json": ("bad ��", 2), "cut.json": ("x", 0)}
    expected = spark.createDataFrame([("good.json",), ("cut.json",), ("none.json",)], "stream string")
    got = {r.stream: (r.rows, r.complete) for r in ev.stream_complete(envelopes, expected).collect()}
    assert got == {"good.json": (1, True), "cut.json": (1, False), "none.json": (0, False)}


def test_manifest(spark, tmp_path):
    run = spark.createDataFrame([("r", "h")], "id string, search_hash string")
    chunks = spark.createDataFrame([(1,)], "id long")
    log = spark.createDataFrame([(1.0, 1, "start", "x" * 5000)], "ts double, chunk long, kind string, detail string")
    sinks.write_manifest(str(tmp_path / "m"), run, chunks, log.limit(0))
    sinks.append_log(log, str(tmp_path / "m"))
    a, b, c = sinks.read_manifest(spark, str(tmp_path / "m"))
    assert (a.count(), b.count(), len(c.first().detail)) == (1, 1, 4000)
    sinks.check_resume(a, "h")
    with pytest.raises(ValueError):
        sinks.check_resume(a, "other")


def test_windows_and_deltas(spark):
    events = spark.createDataFrame([(i, i, i + (i * 7) % 50) for i in range(100)], "event_id long, t long, _indextime long")
    assert ev.time_window(events, 0, 40).count() + ev.time_window(events, 40, 100).count() == 100
    base = ev.extract_events(events, 0, 100, 60).count()
    delta = ev.delta_window(events, 0, 100, 60, 90).count()
    assert base + delta == ev.extract_events(events, 0, 100, 90).count()
    assert ev.pin_snapshot(events, None).count() == 100
    assert ev.whole_days(events.limit(0)) == (0, 0)


def test_compaction_keeps_order_and_what_was_there(spark, assigned, tmp_path):
    rows, chunks = assigned
    sinks.write_ndjson(rows, str(tmp_path / "o"), ["t"])
    done = chunks.join(sinks.written_counts(rows), F.col("start") == F.col("chunk_start")).withColumn("status", F.lit("done")).withColumn("multiline", F.lit(None).cast("long"))
    out = str(tmp_path / "d")
    sinks.compact_days(spark, str(tmp_path / "o"), out, done)
    for day in ("2018-08-20", "2018-08-21"):
        lines = [r.value for r in spark.read.option("lineSep", "\n").text(f"{out}/day={day}").collect()]
        starts = [int(line[5:-1]) // 43200 for line in lines]
        assert starts == sorted(starts)
    before = sorted(p.name for p in (tmp_path / "d").rglob("*.gz"))
    with pytest.raises(ValueError, match="line counts differ"):
        sinks.compact_days(spark, str(tmp_path / "o"), out, done.withColumn("written", F.col("written") + 1))
    assert sorted(p.name for p in (tmp_path / "d").rglob("*.gz")) == before
    assert sorted(p.name for p in tmp_path.iterdir()) == ["d", "o"]


def test_damaged_files(spark, assigned, tmp_path):
    from eventlake.plans import validation as va

    rows, _ = assigned
    out = tmp_path / "o"
    name = F.concat_ws("-", F.col("chunk_start").cast("string"), F.col("chunk_end").cast("string"))
    lines = rows.select(F.col("chunk_day").alias("day"), name.alias("chunk"), encode_json(rows, ["t", "_raw"]).alias("line"))
    sinks.write_lines(lines, str(out))
    planned = sinks.planned_files(lines)
    chunks = planned.select("path", F.col("lines").alias("written"), F.lit(0).alias("multiline"), F.lit("done").alias("status"), "hash_sum", "hash_xor")
    state = lambda: {r.path: r.state for r in va.files_vs_manifest(sinks.written_files(spark, str(out)), chunks).collect()}
    assert set(state().values()) == {"ok"} and len(state()) == 3
    first, second, third = sorted(state())
    for folder, damage in ((first, lambda b: b"not gzip at all"), (second, lambda b: b[: len(b) // 2])):
        (file,) = (out / folder).glob("*.gz")
        file.write_bytes(damage(file.read_bytes()))
        (out / folder / f".{file.name}.crc").unlink(missing_ok=True)
    found = state()
    assert found[first] == "unreadable file" and found[second] in ("wrong lines", "unreadable file") and found[third] == "ok"


def test_samples_differ_as_multisets(spark):
    from eventlake.plans import validation as va

    written = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("c", "z")], "chunk string, line string")
    again = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "w")], "chunk string, line string")
    assert sorted(tuple(r) for r in va.sample_differences(written, again).collect()) == [("a", 1), ("c", 2)]
    assert va.sample_differences(written, written).count() == 0


def test_digest_of_large_keys(spark):
    import hashlib

    from eventlake.functions.encoding import sorted_digest

    rows = [("k", f"line {i % 40}") for i in range(100)] + [("l", "one"), ("l", "one"), ("l", "a\rb")]
    df = spark.createDataFrame(rows, "key string, line string")
    small = {r.key: (r.rows, r.digest) for r in sorted_digest(df, ["key"]).collect()}
    for key in ("k", "l"):
        text = "".join(sorted(x + "\n" for k, x in rows if k == key))
        assert small[key] == (text.count("\n"), hashlib.sha256(text.encode()).hexdigest())
    blocks = lambda d: {r.key: r.digest for r in sorted_digest(d, ["key"], most=10).collect()}
    assert blocks(df) == blocks(df.repartition(5)) and blocks(df)["l"] == small["l"][1]
    other = spark.createDataFrame([*rows[1:], ("k", "line 1")], df.schema)
    assert blocks(other)["k"] != blocks(df)["k"]
