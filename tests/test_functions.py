import pytest
from pyspark.sql import functions as F

from eventlake.functions import encoding, lint, messages, times

D = 1534723200


@pytest.mark.parametrize(
    ("text", "up", "expected"),
    [
        ("1534723200", False, D),
        ("1534723200.4", True, D + 1),
        ("1534723200.4", False, D),
        ("2018-08-20T00:00:00", False, D),
        ("2018-08-20T00:00:00-04:00", False, 1534737600),
        ("2018-08-20T00:00:00Z", False, D),
        (" 2018-08-20 ", False, D),
        ("now", False, D + 5000),
        ("-1h", False, D + 1400),
        ("+2d", False, D + 5000 + 172800),
        ("-1d@d", False, D - 86400),
        ("@h", False, D + 3600),
        ("-1w", False, D + 5000 - 604800),
        ("yesterday", False, None),
        ("", False, None),
    ],
)
def test_resolve_time(spark, text, up, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(times.resolve_time(F.col("s"), F.lit(D + 5000), up)).first()[0] == expected


def _days(spark, start, end, zone):
    df = spark.createDataFrame([(start, end)], "start long, end long")
    return [tuple(r) for r in times.day_bounds(df, zone).orderBy("start").collect()]


def test_day_bounds(spark):
    assert _days(spark, 1534737600, 1534824000, "UTC") == [("2018-08-20", 1534737600, 1534809600), ("2018-08-21", 1534809600, 1534824000)]
    spring = _days(spark, 1772859600, 1772859600 + 47 * 3600, "America/New_York")
    assert [d[0] for d in spring] == ["2026-03-07", "2026-03-08"] and spring[1][2] - spring[1][1] == 82800
    assert _days(spark, 10, 10, "UTC") == [] and _days(spark, 10, 5, "UTC") == []
    half = _days(spark, D, D + 86400, "Asia/Kolkata")
    assert [h[2] - h[1] for h in half] == [66600, 19800] and half[0][2] == half[1][1]


def test_bisect(spark):
    df = spark.createDataFrame([(0, 10), (0, 3)], "a long, b long").select(times.bisect(F.col("a"), F.col("b")).alias("h"))
    assert [[tuple(x) for x in r.h] for r in df.collect()] == [[(0, 5), (5, 10)], [(0, 1), (1, 3)]]
    with pytest.raises(Exception, match="too short"):
        spark.createDataFrame([(5, 6)], "a long, b long").select(times.bisect(F.col("a"), F.col("b"))).collect()


def test_spans():
    assert [times.next_span(*x) for x in ((3600, 1), (60, 10), (1, 1), (600, 600))] == [600, 10, None, None]
    assert times.initial_span(0, 30 * 86400, 3600) == 3600
    assert times.initial_span(0, 3653 * 86400, 3600) == 86400
    span = times.initial_span(0, 3653 * 86400, 60)
    assert 3653 * 86400 // span <= times.MAX_BINS
    with pytest.raises(ValueError):
        times.check_range(5, 5)


def test_time_format_and_path(spark):
    row = spark.range(1).select(times.format_time(F.lit(D)), times.chunk_path(F.lit("d"), F.lit(1), F.lit(2))).first()
    assert tuple(row) == ("2018-08-20T00:00:00.000+00:00", "d/1-2.jsonl.gz")


def test_decode_tolerant(spark):
    cases = [b"bad \xff\xfe", b"", "ok é �".encode(), b"\xf0\x9f\x98", b"\xed\xa0\x80", b"a\xc3(b\xef\xbf\xbd\xff"]
    df = spark.createDataFrame([(bytearray(c),) for c in cases], "b binary").select(encoding.decode_tolerant(F.col("b")).alias("d")).select("d.*")
    for case, (text, replaced) in zip(cases, df.collect()):
        expected = case.decode("utf-8", "replace")
        assert (text, replaced) == (expected, expected.count("�") - case.count("�".encode()))


def test_encoding(spark):
    df = spark.createDataFrame([("r", "t", "h", None)], "_raw string, _time string, host string, x string")
    assert df.select(encoding.encode_json(df, ["_time", "_raw", "x", "nope"])).first()[0] == '{"_time":"t","_raw":"r"}'
    assert encoding.default_fields(False, None, "ndjson") == encoding.DEFAULT_FIELDS
    assert encoding.default_fields(True, None, "ndjson") is None
    assert encoding.default_fields(False, ["a"], "raw") == ["a", "_raw"]
    assert encoding.select_fields(df, ["host", "nope", "_raw"]).columns == ["host", "_raw"]
    lines = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "a")], "k string, line string")
    again = lines.orderBy("line")
    assert encoding.line_digest(lines, ["k"]).collect() == encoding.line_digest(again, ["k"]).collect()
    assert encoding.sorted_digest(lines, ["k"]).collect() == encoding.sorted_digest(again, ["k"]).collect()


def _lint(spark, text):
    df = spark.createDataFrame([(text,)], "search string")
    return sorted((r.level, r.kind, r.word.lower()) for r in lint.lint_searches(df).collect())


def test_lint(spark):
    for text in ("index=a earliest=-1d", "latest=now", "_index_latest=5", "a earliest = 0", "x starttime=1", "endtimeu=4", "searchtimespanhours=1"):
        assert ("error", "time modifier") in [i[:2] for i in _lint(spark, text)]
    assert _lint(spark, "my_latest=1 foo.latest=2") == []
    assert _lint(spark, "x | outputlookup foo") == [("error", "side effect", "outputlookup")]
    assert _lint(spark, "x | head 10 | dedup host") == [("warning", "whole set", "dedup"), ("warning", "whole set", "head")]
    assert _lint(spark, "| tstats count") == [("warning", "generating", "|")]
    assert _lint(spark, "| makeresults") == [("warning", "generating", "makeresults")]
    df = spark.createDataFrame([("index=foo",), ("  search index=foo",), ("| tstats count",), (" ",)], "s string")
    assert [r[0] for r in df.select(lint.normalize_search(F.col("s"))).collect()] == ["search index=foo", "search index=foo", "| tstats count", None]
    df = spark.createDataFrame([("| stats count by host",), ("| fields _raw",)], "s string")
    assert [r[0] for r in df.select(lint.is_whole_set(F.col("s"))).collect()] == [True, False]


def test_messages(spark):
    df = spark.createDataFrame([(None,), ('[{"type":"warn","text":"w"},{"text":"x"}]',), ('[{"type":"fatal","text":"f"}]',)], "j string")
    m = messages.parse_messages(F.col("j"))
    rows = df.select(m.alias("m"), messages.problems(F.lit(False), F.lit(True), m, True).alias("s"), messages.problems(F.lit(True), F.lit(False), m, False).alias("l")).collect()
    assert [[tuple(x) for x in r.m] for r in rows] == [[], [("WARN", "w"), ("", "x")], [("FATAL", "f")]]
    assert rows[1].s == ["job was finalized", "WARN: w"] and rows[1].l == ["job failed"]
    assert rows[2].l == ["job failed", "FATAL: f"]
