import pytest

from eventlake.operators import chunks as ch
from eventlake.plans import validation as va

COLUMNS = (
    "id long, parent long, start long, end long, status string, mode string, expected long, written long, result_count long, "
    "messages array<struct<type:string,text:string>>, path string, multiline long, bytes long, utf8_replacements long"
)


def chunk(id_, start, end, status="done", **more):
    base = {"parent": None, "mode": "job", "expected": 5, "written": 5, "result_count": 5, "messages": [], "path": f"p{id_}", "multiline": 0, "bytes": 10, "utf8_replacements": 1}
    base |= more
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    values = {"id": id_, "start": start, "end": end, "status": status} | base
    return tuple(values[n] for n in names)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def kinds(spark, rows, lo, hi):
    df = spark.createDataFrame(rows, "start long, end long")
    return [tuple(r) for r in va.coverage_gaps(df, lo, hi).collect()]


def test_coverage(spark):
    assert kinds(spark, [(0, 100), (100, 300)], 0, 300) == []
    assert kinds(spark, [], 0, 300) == [("no chunks", 0, 300)]
    assert kinds(spark, [(0, 100), (100, 300), (300, 400)], 0, 300) == [("last", 400, 300)]
    assert kinds(spark, [(0, 100), (150, 300)], 0, 300) == [("gap", 100, 150)]
    got = kinds(spark, [(0, 100), (120, 160), (150, 300)], 0, 300)
    assert ("gap", 100, 120) in got and ("overlap", 150, 160) in got
    assert ("first", 10, 0) in kinds(spark, [(10, 300)], 0, 300)
    assert ("empty", 100, 100) in kinds(spark, [(0, 100), (100, 100), (100, 300)], 0, 300)
    assert len(kinds(spark, [(i * 10, i * 10 + 5) for i in range(50)], 0, 500)) == va.MOST_GAPS


def test_checks(spark):
    good = frame(spark, chunk(1, 0, 50), chunk(2, 50, 100))
    total = spark.createDataFrame([(10,)], "n long")
    checks = va.validate(good, 0, 100, "total", total=total)
    assert checks.where("NOT ok").count() == 0 and checks.count() == 7
    assert va.run_verdict(good, checks).first().ok
    bad = frame(
        spark,
        chunk(1, 0, 50, written=4, result_count=5),
        chunk(2, 50, 90, messages=[("WARN", "w")]),
        chunk(3, 95, 100, status="failed"),
    )
    failed = {r.name for r in va.validate(bad, 0, 100, "total", total=total).where("NOT ok").collect()}
    assert failed == {"coverage", "all-chunks-done", "written-eq-resultCount", "no-job-warnings", "written-eq-expected", "total-count"}
    lenient = va.validate(bad, 0, 100, "job", strict=False)
    assert lenient.where("name = 'no-job-warnings' AND ok").count() == 1


def test_full_level(spark):
    chunks = frame(spark, chunk(1, 0, 50), chunk(2, 50, 100))
    files = spark.createDataFrame([("p1", 5), ("p3", 1)], "path string, lines long")
    recount = spark.createDataFrame([(0, 50, 5), (50, 100, 6)], "start long, end long, n long")
    checks = {r.name: r.bad for r in va.validate(chunks, 0, 100, "full", files=files, recount=recount).collect()}
    assert checks["files-intact"] == 2 and checks["per-chunk-recount"] == 1
    states = {r.path: r.state for r in va.files_vs_manifest(files, chunks).collect()}
    assert states == {"p1": "ok", "p2": "missing file", "p3": "unknown file"}


def test_vacuous_plan(spark):
    unknown = frame(spark, chunk(1, 0, 50, expected=None), chunk(2, 50, 100, expected=None))
    checks = {r.name: r.ok for r in va.validate(unknown, 0, 100, "plan").collect()}
    assert not checks["written-eq-expected"]
    assert {r.name: r.ok for r in va.validate(unknown, 0, 100, "plan", used_histogram=False).collect()}["written-eq-expected"]


def test_split_tree(spark):
    tree = frame(
        spark,
        chunk(1, 0, 100, "split", expected=9),
        chunk(2, 0, 50, "split", parent=1, expected=6),
        chunk(3, 50, 100, parent=1, written=3),
        chunk(4, 0, 25, parent=2, written=4),
        chunk(5, 25, 50, "failed", parent=2, written=None),
    )
    got = {r.id: (r.children, r.ok) for r in va.split_rollup(tree).collect()}
    assert got == {1: (7, False), 2: (4, False)}


def test_resume_and_totals(spark):
    rows = frame(spark, chunk(1, 0, 50), chunk(2, 50, 60, "running"), chunk(3, 60, 70, "failed"), chunk(4, 70, 99, "split"), chunk(5, 99, 100, "mismatch"))
    left = ch.remaining_chunks(rows, va.done(rows))
    assert sorted(r.id for r in left.collect()) == [2, 3, 5]
    assert tuple(va.run_totals(rows).first()) == (10, 20, 2, 0)


def test_report(spark, tmp_path):
    chunks = frame(spark, chunk(1, 0, 100))
    checks = va.validate(chunks, 0, 100, "job")
    text = va.write_report(checks, chunks.where("status <> 'done'"), str(tmp_path / "r"))
    assert "| coverage | ok | 0 |" in text and spark.read.json(str(tmp_path / "r/checks")).count() == 4


def test_deep_and_circular_trees(spark):
    chain = [chunk(i, 0, 1, "split", parent=i - 1 if i > 1 else None, expected=3) for i in range(1, 41)]
    tree = frame(spark, *chain, chunk(41, 0, 1, parent=40, written=3))
    got = va.split_rollup(tree).collect()
    assert len(got) == 40 and all(r.ok and r.children == 3 for r in got)
    circle = frame(spark, chunk(1, 0, 1, "split", parent=2), chunk(2, 0, 1, "split", parent=1), chunk(3, 0, 1, parent=2))
    with pytest.raises(ValueError, match="below itself"):
        va.split_rollup(circle)


def test_coverage_across_days(spark):
    day = 86400
    assert kinds(spark, [(i * day, (i + 1) * day) for i in range(5)], 0, 5 * day) == []
    assert kinds(spark, [(0, day), (2 * day, 3 * day)], 0, 3 * day) == [("gap", day, 2 * day)]
    assert kinds(spark, [(0, day + 50), (day, 2 * day)], 0, 2 * day) == [("overlap", day, day + 50)]


def test_notes_and_sample(spark):
    good = frame(spark, chunk(1, 0, 50), chunk(2, 50, 100))
    sample = spark.createDataFrame([("1", 2)], "chunk string, lines long")
    rows = {r.name: (r.ok, r.bad, r.detail) for r in va.validate(good, 0, 100, "full", sample=sample, notes=True).collect()}
    assert rows["sample-reextract"] == (False, 1, "1 chunks") and rows["utf8-replacements"] == (True, 2, "2 replaced sequences")
    assert rows["coverage"] == (True, 0, "0 gaps or overlaps")
