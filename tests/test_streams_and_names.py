import json

import pytest
from pyspark.sql import functions as F

from eventlake.operators import chunks as ch
from eventlake.operators import planning
from eventlake.sources import events as ev

GOOD = b'{"preview":false,"offset":0,"result":{"id":"1","tags":["x","y"],"n":1.50,"none":null}}\n'
LAST = b'{"preview":false,"result":{"id":"2","b":"\xc3\xa9 \xff","a":{"k":[1]}},"lastrow":true}'


def stream(tmp_path, body):
    (tmp_path / "s").mkdir(exist_ok=True)
    (tmp_path / "s/a.json").write_bytes(body)
    return str(tmp_path / "s")


MALFORMED = [b'{"preview":false,"result":{"id"', b"[1]", b"3", b"nonsense", b'{"a":1} x', b'{"result":null}', b'{"result":"x"}', b'{"result":[{"a":1}]}']


@pytest.mark.parametrize("line", MALFORMED)
def test_malformed_lines_are_never_lost(spark, tmp_path, line):
    path = stream(tmp_path, GOOD + line + b"\n" + LAST)
    with pytest.raises(Exception, match="malformed line in"):
        ev.read_export_stream(spark, path).count()
    kept = ev.read_export_stream(spark, path, "keep").withColumn("stream", F.lit("a"))
    state = ev.stream_state(kept, spark.createDataFrame([("a",), ("b",)], "stream string"))
    assert sorted(tuple(r) for r in state.collect()) == [("a", 2, 1, 1, False), ("b", 0, 0, 0, False)]
    assert ev.export_rows(kept).count() == 2


def test_blank_lines_and_last_rows(spark, tmp_path):
    path = stream(tmp_path, b"\r\n\n \t\n" + GOOD.replace(b"\n", b"\r\n") + b"\x0b\x0c\r\n" + LAST)
    envelopes = ev.read_export_stream(spark, path)
    assert envelopes.count() == 2
    state = ev.stream_complete(envelopes, envelopes.select("stream").distinct())
    assert [(r.rows, r.complete) for r in state.collect()] == [(2, True)]
    with pytest.raises(ValueError):
        ev.read_export_stream(spark, path, "drop")


def test_values_keep_their_types(spark, tmp_path):
    envelopes = ev.read_export_stream(spark, stream(tmp_path, GOOD + LAST))
    whole = sorted(r.line for r in ev.export_lines(envelopes).collect())
    assert [json.loads(x) for x in whole] == [{"id": "1", "tags": ["x", "y"], "n": 1.5, "none": None}, {"id": "2", "b": "é �", "a": {"k": [1]}}]
    assert list(json.loads(whole[1])) == ["id", "b", "a"]
    some = sorted(r.line for r in ev.export_lines(envelopes, ["tags", "id", "none", "no such.field"]).collect())
    assert some == ['{"id":"2"}', '{"tags":["x","y"],"id":"1","none":null}']


CHUNKS = [("2018-08-20", 1534723200, 1534723200 + 43200), ("2018-08-20", 1534723200 + 43200, 1534723200 + 86400)]


def test_users_columns_of_any_name(spark):
    names = ["_day", "_hour", "_at", "hour", "day", "AT", "_rank", "rank", "_n", "n", "before", "_before", "cut", "s", "e", "counted", "start", "end", "touched", "ended"]
    rows = [(i, 1534723200 + i * 600, *[f"{c}{i}" for c in names]) for i in range(140)]
    events = spark.createDataFrame(rows, "event_id long, t long, " + ", ".join(f"`{c}` string" for c in names))
    chunks = spark.createDataFrame(CHUNKS, "day string, start long, end long")
    assigned = ch.assign_chunks(events, chunks)
    assert assigned.columns == [*events.columns, "chunk_start", "chunk_end", "chunk_day"]
    assert sorted(tuple(r)[: len(rows[0])] for r in assigned.collect()) == rows
    paged = ch.paginate(assigned, 10, ["t", "event_id"])
    assert paged.columns == [*assigned.columns, "page"] and {r.page for r in paged.collect()} == set(range(8))
    capped = ch.capped_result(assigned, 5)
    assert capped.columns == [*assigned.columns, "truncated"] and capped.count() == 10
    oldest = ch.capped_result(assigned, 1, ["t"]).orderBy("t").collect()
    assert [r.event_id for r in oldest] == [0, 72]
    with pytest.raises(ValueError, match="chunk_start"):
        ch.assign_chunks(assigned, chunks)
    wide = chunks.select("*", F.lit("export").alias("mode"), F.lit("done").alias("status"), F.lit(None).cast("long").alias("expected"), F.lit(1).alias("counted"), F.lit(2).alias("s"), F.lit(3).alias("n"), F.lit(4).alias("e"))
    found = ch.expect_exports(wide, events)
    assert found.columns == wide.columns and sorted(r.expected for r in found.collect()) == [68, 72]
    bins = spark.createDataFrame([(0, 10, 1, 2), (5, 20, 3, 4)], "start long, end long, touched long, ended long")
    assert [tuple(r) for r in planning.overlapping(bins).collect()] == [(5, 20, 3, 4)]
