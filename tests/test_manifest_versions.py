import threading

import pytest
from pyspark.sql import functions as F

from eventlake.sources import sinks
from eventlake.sources.extracted import read_chunks, write_chunks
from eventlake.sources.manifest import CHECKPOINT_EVERY, Change, Conflict, Manifest


@pytest.fixture
def manifest(spark, tmp_path):
    made = Manifest(spark, str(tmp_path / "m"))
    plan = spark.createDataFrame([(i, "2018-08-20", i * 100, i * 100 + 100, i, False) for i in range(1, 9)], "id long, day string, start long, end long, expected long, hot boolean")
    made.create(spark.createDataFrame([("r",)], "id string"), plan)
    return made


def states(manifest, version=None):
    return {r.id: (r.status, r.attempts, r.worker) for r in manifest.chunks(version).collect()}


def test_claims_splits_and_requeues(spark, manifest):
    assert manifest.run().first().id == "r" and set(states(manifest).values()) == {("pending", 0, None)}
    assert sorted(r.id for r in manifest.claim("a", 2, 10).collect()) == [1, 2]
    assert sorted(r.id for r in manifest.claim("b", 2, 10, oldest_first=False).collect()) == [7, 8]
    manifest.finish(spark.createDataFrame([(1, "done", 5), (3, "done", 5)], "id long, status string, written long"), 11)
    assert states(manifest)[3] == ("pending", 0, None)  # not running
    halves = spark.createDataFrame([(8, "2018-08-20", 800, 850), (8, "2018-08-20", 850, 900)], "parent long, day string, start long, end long")
    manifest.split(halves, 12)
    manifest.split(halves, 13)
    rows = {r.id: r for r in manifest.chunks().collect()}
    assert sorted(rows) == list(range(1, 11)) and rows[8].status == "split" and (rows[9].parent, rows[9].start, rows[9].status) == (8, 800, "pending")
    manifest.finish(spark.createDataFrame([(7, "failed", "why")], "id long, status string, error string"), 14)
    manifest.requeue(15)
    after = states(manifest)
    assert after[2] == ("pending", 0, None) and after[7] == ("pending", 0, None) and after[1][0] == "done" and after[8][0] == "split"
    assert states(manifest, 1)[1] == ("running", 1, "a") and set(states(manifest, 0).values()) == {("pending", 0, None)}
    log = [(r.version, r.chunk, r.kind) for r in manifest.log().orderBy("version", "chunk").collect()]
    assert log[:5] == [(1, 1, "running"), (1, 2, "running"), (2, 7, "running"), (2, 8, "running"), (3, 1, "done")] and log[-1] == (7, 7, "requeued")
    with pytest.raises(ValueError):
        manifest.chunks(99)


def test_one_of_two_writers_loses_and_tries_again(spark, manifest):
    other, calls = Manifest(spark, manifest.path), []

    def change(chunks):
        calls.append(1)
        if len(calls) == 1:
            other.claim("first", 3, 0)
        rows = chunks.where("status = 'pending'").orderBy("start").limit(3)
        return Change(rows.withColumns({"status": F.lit("running"), "worker": F.lit("second")}))

    assert manifest.update("claim", change) == 2 and len(calls) == 2
    got = states(manifest)
    assert [got[i][2] for i in range(1, 8)] == ["first"] * 3 + ["second"] * 3 + [None]
    with pytest.raises(Conflict):
        manifest._commit(2, {})
    with pytest.raises(ValueError, match="already"):
        manifest.create(manifest.run(), manifest.chunks())


def test_workers_never_share_a_chunk(spark, manifest):
    got = {}
    threads = [threading.Thread(target=lambda w=w: got.__setitem__(w, {r.id for r in Manifest(spark, manifest.path).claim(w, 2, 0).collect()})) for w in "abcd"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(i for ids in got.values() for i in ids) == list(range(1, 9)) and manifest.versions() == [0, 1, 2, 3, 4]


def test_a_crash_before_the_commit_leaves_the_version_before(spark, manifest, monkeypatch):
    before = states(manifest)
    monkeypatch.setattr(Manifest, "_commit", lambda *a: (_ for _ in ()).throw(OSError("crash")))
    with pytest.raises(OSError):
        manifest.claim("a", 2, 0)
    monkeypatch.undo()
    assert states(manifest) == before and manifest.versions() == [0]
    manifest.claim("a", 2, 0)
    assert manifest.versions() == [0, 1]


def test_whole_versions_are_read_alone(spark, manifest):
    for _ in range(CHECKPOINT_EVERY + 1):
        manifest.requeue(0)
    assert [e["version"] for e in manifest._entries(None)] == [CHECKPOINT_EVERY, CHECKPOINT_EVERY + 1]
    assert len(states(manifest)) == 8


def test_source_reads_what_the_manifest_names(spark, manifest, tmp_path):
    out = str(tmp_path / "out")
    texts = {i: [f"{i} line\r {k} é" for k in range(i * 3)] for i in range(1, 8)}
    lines = spark.createDataFrame([(i, "2018-08-20", i * 100, i * 100 + 100, x) for i, rows in texts.items() for x in rows], "chunk long, day string, start long, end long, line string")
    manifest.claim("a", 8, 0)
    should = spark.createDataFrame([(i, i * 3 + (i == 5)) for i in range(1, 9)], "id long, written long")
    version = write_chunks(lines, out, manifest, 1, should)
    found = {r.id: (r.status, r.written) for r in manifest.chunks().collect()}
    assert found[5] == ("mismatch", 15) and found[8] == ("mismatch", 0) and found[2] == ("done", 6)
    stray = next((tmp_path / "out/day=2018-08-20/chunk=200-300").glob("*.gz"))
    (stray.parent / "stray.gz").write_bytes(b"half a file")
    read = read_chunks(spark, manifest)
    assert sorted((r.chunk, r.line) for r in read.collect()) == sorted((i, x) for i, rows in texts.items() if i != 5 for x in rows)
    few = read.where("start >= 200 AND start < 400 AND day = '2018-08-20' AND line LIKE '%line%'")
    assert few.count() == 15 and few.rdd.getNumPartitions() == 2 and "start" in few._jdf.queryExecution().toString()
    assert read_chunks(spark, manifest, version - 1).count() == 0
    files = manifest.chunks().where("id = 3").first().files
    again = sinks.written_files(spark, out).where("path LIKE '%chunk=300-400'").first()
    assert (sum(f.lines for f in files), sum(f.bytes for f in files), sum(f.hash_sum for f in files)) == (again.lines, again.bytes, again.hash_sum)
    stray.write_bytes(stray.read_bytes()[:-3])
    with pytest.raises(Exception, match="ends inside a gzip member"):
        read.collect()
