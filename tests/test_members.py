import gzip
import io
import os
import zlib

import pytest
from pyspark.sql import functions as F

from eventlake.functions.encoding import encode_json
from eventlake.operators import chunks as ch
from eventlake.plans import validation as va
from eventlake.sources import members, sinks

D = 1534723200


def scanned(raw, block=7, most=11):
    return list(members.scan_members((raw[i : i + block] for i in range(0, len(raw), block)), most))


def test_members_of_a_stream():
    one, two, none = gzip.compress(b"a\nbc\n"), gzip.compress(b"x" * 500 + b"\nend"), gzip.compress(b"")
    got = scanned(one + two + none + b"\0" * 20)
    assert [g[2:] for g in got] == [(2, 5, True, None), (2, 504, False, None), (0, 0, True, None)]
    assert [g[:2] for g in got] == [(0, len(one)), (len(one), len(two)), (len(one) + len(two), len(none))]
    assert [g[2:] for g in scanned(one + b"\0\0" + one)] == [(2, 5, True, None)] * 2
    assert scanned(b"")[0][5] and scanned(b"plain text")[0][5] and scanned(one + b"junk")[-1][5]
    assert all(g[5] is None for g in scanned(gzip.compress(b"z" * 100_000), 5, 64))


@pytest.mark.parametrize("block,most", [(7, 11), (1 << 20, 1 << 20), (1, 1)])
def test_every_change_of_the_trailer_is_found(block, most):
    raw = gzip.compress(b"line\n" * 30)
    assert [g[5] for g in scanned(raw, block, most)] == [None]
    for k in range(1, 9):
        assert scanned(raw[:-k], block, most)[-1][5], k
        for bit in range(8):
            flipped = bytearray(raw)
            flipped[-k] ^= 1 << bit
            assert scanned(bytes(flipped), block, most)[-1][5], (k, bit)


def test_a_large_member_in_little_memory():
    import tracemalloc

    def blocks():
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        line = (b"0123456789abcdef" * 64)[:-1] + b"\n"
        for _ in range(256):
            if data := packer.compress(line * 1024):
                yield data
        yield packer.flush()

    tracemalloc.start()
    (got,) = members.scan_members(blocks())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[2:] == (256 * 1024, 256 << 20, True, None) and peak < 12 << 20


def output(spark, path, n=400):
    rows = [(i, D + i * 400, f"raw {i}") for i in range(n)]
    events = spark.createDataFrame(rows, "event_id long, t long, _raw string")
    spans = [(D + k * 21600, D + (k + 1) * 21600) for k in range(8)]
    chunks = spark.createDataFrame([("2018-08-20" if s < D + 86400 else "2018-08-21", s, e) for s, e in spans], "day string, start long, end long")
    sinks.write_ndjson(ch.assign_chunks(events, chunks), path, ["t", "_raw"])
    counts = ch.chunk_counts(events, chunks)
    return events, counts.select("day", "start", "end", F.lit("done").alias("status"), F.col("n").alias("written"), F.lit(None).cast("long").alias("multiline"))


def test_compaction_by_members(spark, tmp_path):
    path, out = str(tmp_path / "o"), str(tmp_path / "d")
    _, done = output(spark, path)
    days = members.compact_members(spark, path, out, done)
    assert sorted(tuple(r) for r in days.collect()) == [("2018-08-20", 216), ("2018-08-21", 184)]
    assert sorted(p.name for p in (tmp_path / "d").rglob("*") if p.is_file()) == ["days-000000.gz"] * 2
    for day in ("2018-08-20", "2018-08-21"):
        raw = (tmp_path / f"d/day={day}/days-000000.gz").read_bytes()
        text = gzip.open(io.BytesIO(raw)).read().decode().splitlines()
        starts = [(int(line[5:15]) - D) // 21600 for line in text]
        assert starts == sorted(starts)
    # Bytes are copied, so the members are those of the chunks.
    lengths = lambda p: sorted(r["length"] for r in members.gzip_members(spark, p).collect())
    assert lengths(path) == lengths(out)
    small = str(tmp_path / "s")
    members.compact_members(spark, path, small, done, file_bytes=1)
    assert len(list((tmp_path / "s").rglob("*.gz"))) == 8 and sinks.read_extracted(spark, small).count() == 400
    with pytest.raises(ValueError, match="line counts differ"):
        members.compact_members(spark, path, out, done.withColumn("written", F.col("written") + 1))
    with pytest.raises(ValueError, match="not every chunk"):
        members.compact_members(spark, path, out, done.withColumn("status", F.lit("pending")))
    assert sinks.read_extracted(spark, out).count() == 400
    file = next((tmp_path / "o").rglob("*.gz"))
    file.write_bytes(file.read_bytes()[:-1])
    with pytest.raises(ValueError, match="damaged"):
        members.compact_members(spark, path, out, done)
    assert sorted(os.listdir(tmp_path)) == ["d", "o", "s"]


def test_cut_files_and_true_reextraction(spark, tmp_path):
    path = str(tmp_path / "o")
    events, done = output(spark, path)
    name = F.concat(F.lit("day="), "day", F.lit("/chunk="), F.concat_ws("-", F.col("start").cast("string"), F.col("end").cast("string")))
    chunks = done.select("*", name.alias("path"), F.monotonically_increasing_id().alias("id"), F.col("written").alias("expected"), F.col("written").alias("result_count"), F.lit("job").alias("mode"))
    chunks = spark.createDataFrame(chunks.collect(), chunks.schema)
    file = sorted((tmp_path / "o").rglob("*.gz"))[0]
    raw = bytearray(file.read_bytes())
    raw[-2] ^= 4
    file.write_bytes(bytes(raw))
    (file.parent / f".{file.name}.crc").unlink()
    states = {r.path: r.state for r in va.files_vs_manifest(members.checked_files(spark, path), chunks).collect()}
    assert sorted(states.values()) == ["ok"] * 7 + ["unreadable file"]
    # One event has changed since the first extraction; the file on disk is as it was written.
    late = events.withColumn("_raw", F.when(F.col("event_id") == 100, "changed").otherwise(F.col("_raw")))
    again = lambda df, c=chunks, pin=None: va.sample_reextract(c, df, sinks.read_extracted(spark, path, damaged=True), 50, "s", ["t", "_raw"], pin)
    assert again(late).count() == 1 + again(events).count()
    issues = va.chunk_issues(chunks, members.checked_files(spark, path), sample=again(late)).where("issue = 'reextract' AND found = '2'")
    assert issues.count() == 1
    pinned = events.withColumn("_indextime", F.col("event_id"))
    assert again(pinned, pin=300).count() == again(pinned.where("event_id < 300")).count() > again(events).count()
    compacted = chunks.withColumn("path", F.col("day"))
    assert again(late, compacted).count() == 0


def test_small_chunks_share_files(spark, tmp_path):
    rows = [(i, D + i * 400, None if i == 3 else f'raw "{i}"\n\u00e9' * (i % 4)) for i in range(432)]
    events = spark.createDataFrame(rows, "event_id long, t long, _raw string")
    chunks = spark.createDataFrame([("2018-08-20" if k < 36 else "2018-08-21", D + k * 2400, D + k * 2400 + 2400) for k in range(72)], "day string, start long, end long")
    out, assigned = str(tmp_path / "o"), ch.assign_chunks(events, chunks)
    members.write_members(assigned, out, ["t", "_raw", "missing"])
    line = encode_json(assigned, ["t", "_raw"])
    expected = sorted(tuple(r) for r in assigned.select("chunk_day", "chunk_start", "chunk_end", line).collect())
    got = members.read_members(spark, out)
    assert sorted(tuple(r)[:4] for r in got.collect()) == expected and got.columns == ["day", "start", "end", "line", "file"]
    # 72 chunks: one member each, in no more files than a task writes for each day.
    files = list((tmp_path / "o").rglob("*.gz"))
    places = members.member_places(spark, out)
    assert len(files) <= 2 * 4 and {str(f.relative_to(tmp_path / "o")) for f in files} == {r.file for r in places.collect()}
    assert sorted((r.start, r.lines) for r in places.collect()) == [(D + k * 2400, 6) for k in range(72)]
    found = members.gzip_members(spark, out)
    assert found.count() == 72 and found.where("problem IS NOT NULL OR NOT ended").count() == 0
    # Other readers of lines take such files too.
    assert sorted(tuple(r) for r in sinks.read_extracted(spark, out).select("day", "line").collect()) == sorted((r[0], r[3]) for r in expected)
    one = members.read_members(spark, out, places.where(F.col("start") == D + 7 * 2400)).collect()
    assert sorted(r.line for r in one) == sorted(r[3] for r in expected if r[1] == D + 7 * 2400)
    # Files that the index does not name are not read; a member that is cut is an error.
    (tmp_path / "o/day=2018-08-20/stray.gz").write_bytes(gzip.compress(b"stray\n"))
    assert members.read_members(spark, out).count() == 432
    files[0].write_bytes(files[0].read_bytes()[:-3])
    with pytest.raises(Exception, match="no whole member"):
        members.read_members(spark, out).count()


def test_without_events_there_are_no_members(spark, tmp_path):
    events = spark.createDataFrame([], "event_id long, t long, _raw string")
    chunks = spark.createDataFrame([("2018-08-20", D, D + 60)], "day string, start long, end long")
    members.write_members(ch.assign_chunks(events, chunks), str(tmp_path / "o"))
    assert members.read_members(spark, str(tmp_path / "o")).collect() == []


def test_lines_of_large_members():
    lines = [b"x" * 3_000_000, b"", b"y" * 17, *[b"z" * 100] * 50_000]
    one, two = gzip.compress(b"a\nb\n"), gzip.compress(b"\n".join(lines) + b"\n")
    read = lambda begins, length: [x for part in members._member_lines(io.BytesIO(one + two), "f", begins, length) for x in part]
    assert read(0, len(one)) == [b"a", b"b"] and read(len(one), len(two)) == lines
    for begins, length in ((len(one), len(two) - 1), (len(one), len(two) + 1), (0, len(one) + 5)):
        with pytest.raises(EOFError):
            read(begins, length)


def test_a_task_that_fails_leaves_no_file(tmp_path):
    import pyarrow as pa

    def batches():
        yield pa.RecordBatch.from_pydict({"day": ["d"], "start": [1], "end": [2], "line": ["x\n"]})
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        list(members._write_chunks(str(tmp_path / "o"))(batches()))
    assert not [f for f in (tmp_path / "o").rglob("*") if f.is_file()]


def test_files_of_the_pinned_extraction_follow_tasks(spark, tmp_path, monkeypatch):
    from eventlake.plans import growth_queries

    monkeypatch.setattr(growth_queries.sinks, "scratch_dir", lambda _, name: str(tmp_path / name))
    rows = growth_queries.pinned_extraction(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 8 and all(r.expected == r.written for r in rows)
    files = len(list((tmp_path / "output").rglob("*.gz")))
    assert files <= 8 * 4 < spark.read.parquet(str(tmp_path / "plan")).where("expected > 0").count()
