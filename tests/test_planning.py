import random

import pytest
from pyspark.sql import functions as F

from eventlake.functions.times import next_span
from eventlake.operators import chunks as ch
from eventlake.operators import planning

D = 1534723200
H = 3600
DAY = 86400


def bins_df(spark, bins):
    return spark.createDataFrame(bins, "start long, end long, count long")


def ranges(spark, start, end):
    return spark.createDataFrame([(start, end)], "start long, end long")


def packed(spark, bins, start, end, target):
    rows = planning.pack(bins_df(spark, bins), ranges(spark, start, end), target).orderBy("start").collect()
    assert [r.start for r in rows[1:]] == [r.end for r in rows[:-1]]
    assert rows[0].start == start and rows[-1].end == end
    return [(r.start - D, r.end - D, r.expected, r.hot) for r in rows]


def test_pack_cases(spark):
    hourly = [30, 40, 50, 0, 90, 10, 200, 5]
    bins = [(D + i * H, D + (i + 1) * H, n) for i, n in enumerate(hourly) if n]
    assert packed(spark, bins, D, D + DAY, 100) == [
        (0, 2 * H, 70, False), (2 * H, 4 * H, 50, False), (4 * H, 6 * H, 100, False), (6 * H, 7 * H, 200, True), (7 * H, DAY, 5, False),
    ]
    assert packed(spark, [], D, D + 2 * DAY, 100) == [(0, DAY, 0, False), (DAY, 2 * DAY, 0, False)]
    two = [(D, D + H, 200), (D + 2 * H, D + 3 * H, 200)]
    assert packed(spark, two, D, D + DAY, 100) == [(0, H, 200, True), (H, 2 * H, 0, False), (2 * H, 3 * H, 200, True), (3 * H, DAY, 0, False)]
    late = [(D + H, D + 2 * H, 500), (D + 2 * H, D + 3 * H, 50)]
    assert packed(spark, late, D + 1800, D + DAY, 100) == [(1800, H, 0, False), (H, 2 * H, 500, True), (2 * H, DAY, 50, False)]


def test_pack_straddling_bin_leaves_counts_unknown(spark):
    got = packed(spark, [(D + DAY - H, D + DAY + H, 10)], D, D + 2 * DAY, 100)
    assert [c[2] for c in got] == [None, None]


def test_overlapping_bins(spark):
    assert planning.overlapping(bins_df(spark, [(0, 3600, 1), (1800, 5400, 1)])).count() == 1
    assert planning.overlapping(bins_df(spark, [(0, 3600, 1), (3600, 5400, 1)])).count() == 0


def test_pack_random_days(spark):
    rng = random.Random(7)
    for _ in range(6):
        start = D + rng.randrange(0, 3 * H, 60)
        end = start + rng.randrange(H, 3 * DAY, 60)
        span = rng.choice([600, 3600])
        bins = []
        for s in range(start // span * span, end, span):
            n = rng.choice([0, 1, 50, 99, 100, 101, 400])
            if n:
                bins.append((max(s, start), min(s + span, end), n))
        got = packed(spark, bins, start, end, 100)
        assert sum(c[2] for c in got) == sum(b[2] for b in bins)
        assert all(c[2] <= 100 for c in got if not c[3])


def by_the_rules(bins, opens, closes, target):
    """Chunks of a day from the rules: (start, end, expected, hot)."""
    out, start, held = [], opens, 0
    for s, e, n in bins:
        if n > target or held + n > target:
            if s > start:
                out.append((start, s, held, False))
            start, held = s, 0
        if n > target:
            out.append((s, e, n, True))
            start = e
        else:
            held += n
    return out + [(start, closes, held, False)] * (closes > start)


def test_pack_500_random_days():
    """Tiles, sums, bounds, and the chunks of the rules."""
    import pandas as pd

    rng = random.Random(7)
    pack = planning._pack_day(100)
    for _ in range(500):
        opens = D + rng.randrange(0, 12 * H)
        closes = rng.randrange(opens + 60, D + DAY + 1)
        span = rng.choice([60, 600, 3600])
        bins = [(max(s, opens), min(s + span, closes), rng.choice([0, 1, 50, 99, 100, 101, 400])) for s in range(opens // span * span, closes, span)]
        if rng.random() < 0.5:
            bins = [b for b in bins if b[2]]
        rows = [("2018-08-20", opens, closes, *b) for b in bins] or [("2018-08-20", opens, closes, None, None, None)]
        rng.shuffle(rows)
        got = [tuple(r)[1:] for r in pack(pd.DataFrame(rows, columns=["day", "ds", "de", "start", "end", "count"])).itertuples(index=False)]
        assert [c[0] for c in got] == [opens] + [c[1] for c in got[:-1]] and got[-1][1] == closes
        assert sum(c[2] for c in got) == sum(b[2] for b in bins) and all(c[3] or c[2] <= 100 for c in got)
        assert got == by_the_rules(bins, opens, closes, 100)


def test_pack_refuses_overlapping_bins(spark):
    with pytest.raises(Exception, match="bins overlap"):
        planning.pack(bins_df(spark, [(D, D + H, 1), (D + 1800, D + 5400, 1)]), ranges(spark, D, D + DAY), 100).count()


def test_pack_bins_of_several_days(spark):
    got = packed(spark, [(D, D + 4 * DAY, 10)], D, D + 4 * DAY, 100)
    assert got == [(i * DAY, (i + 1) * DAY, None, False) for i in range(4)]


def test_spans():
    from eventlake.functions.times import MAX_BINS, SPAN_LADDER, initial_span

    assert initial_span(0, 30 * DAY, 3600) == 3600 and initial_span(0, 3653 * DAY, 3600) == 86400
    for length in (0, 1, 40_000, 40_001, 40_002, 2_400_059, 10**9, 10**11, 10**12):
        for requested in (1, 7, 60, 3600, 50_000, 86_400, 100_000):
            span = requested  # coarser step by step
            while length // span > MAX_BINS:
                span = min((s for s in SPAN_LADDER if s > span), default=span * 4)
            assert initial_span(5, 5 + length, requested) == span


def test_fixed_chunks(spark):
    rows = planning.fixed_chunks(ranges(spark, D + 1000, D + DAY + 500), 21600).orderBy("start").collect()
    assert [r.end - D for r in rows] == [22600, 44200, 65800, 86400, 86900]
    assert {r.expected for r in rows} == {None}


def naive(seconds, start, end, span, target, least):
    """Bins by plain recursion."""
    out = []

    def go(lo, hi, s):
        groups = {}
        for t, n in seconds.items():
            if lo <= t < hi:
                groups[t // s * s] = groups.get(t // s * s, 0) + n
        for at, n in groups.items():
            a, b = max(at, lo), min(at + s, hi)
            nxt = next_span(s, least)
            if n <= target or b - a <= least or nxt is None:
                out.append((a, b, n))
            else:
                go(a, b, nxt)

    go(start, end, span)
    return sorted(out)


@pytest.mark.parametrize(("span", "least", "seed"), [(3600, 1, 1), (86400, 60, 2), (5000, 7, 3)])
def test_refine_equals_recursion(spark, span, least, seed):
    rng = random.Random(seed)
    start, end = D + 500, D + 30000
    events = [D + int(rng.betavariate(0.3, 0.9) * 31000) for _ in range(600)] + [D + 7777] * 40
    seconds = {}
    for t in events:
        seconds[t] = seconds.get(t, 0) + 1
    df = spark.createDataFrame([(t,) for t in events], "t long")
    got = sorted(tuple(r) for r in planning.refine(df, start, end, span, 12, least).collect())
    assert got == naive(seconds, start, end, span, 12, least)


def test_every_event_in_one_chunk_and_broadcast(spark):
    rng = random.Random(3)
    events = spark.createDataFrame([(i, D + rng.randrange(2 * DAY)) for i in range(2000)], "event_id long, t long")
    plan = planning.plan(events, D, D + 2 * DAY, 3600, 50)
    assigned = ch.assign_chunks(events, plan)
    assert assigned.count() == 2000 and assigned.select("event_id").distinct().count() == 2000
    counted = ch.chunk_counts(events, plan)
    assert counted.where("n <> expected").count() == 0
    text = assigned._jdf.queryExecution().toString()
    assert "NestedLoopJoin" not in text and "BroadcastHashJoin" in text


def test_bisection(spark):
    events = spark.createDataFrame([(i, 10 * i) for i in range(10)], "event_id long, t long")
    chunk = spark.createDataFrame([("1970-01-01", 0, 100)], "day string, start long, end long")
    tree = ch.bisect_overflow(chunk, events, 4)
    leaves = tree.where("status = 'done'").orderBy("start").collect()
    assert [(r.start, r.end, r.n) for r in leaves] == [(0, 25, 3), (25, 50, 2), (50, 75, 3), (75, 100, 2)]
    assert tree.where("status = 'split'").count() == 3
    hot = spark.createDataFrame([(i, 5) for i in range(10)], "event_id long, t long")
    only = ch.bisect_overflow(spark.createDataFrame([("1970-01-01", 5, 6)], "day string, start long, end long"), hot, 4).collect()
    assert [(r.mode, r.status, r.n) for r in only] == [("export", "done", 10)]


def test_outcomes(spark):
    rows = [
        (False, [], 10, 10, 1, "done"), (False, [], 11, 10, 1, "retry"), (False, [], 11, 10, 2, "mismatch"), (False, [], None, 10, 2, "done"),
        (False, ["FATAL: x"], 10, 10, 2, "failed"), (False, ["x"], 10, 10, 1, "retry"), (True, ["x"], 10, 10, 2, "overflow"),
    ]
    df = spark.createDataFrame(rows, "t boolean, p array<string>, e long, w long, a int, expected string")
    got = df.select(ch.chunk_outcome(F.col("t"), F.col("p"), F.col("e"), F.col("w"), F.col("a"), 2).alias("o"), "expected").collect()
    assert all(r.o == r.expected for r in got)


def test_pages_and_caps(spark):
    events = spark.createDataFrame([(i, 10 * i) for i in range(10)], "event_id long, t long")
    chunk = spark.createDataFrame([("1970-01-01", 0, 100)], "day string, start long, end long")
    assigned = ch.assign_chunks(events, chunk)
    assert ch.paginate(assigned, 3, ["t"]).select("page").distinct().count() == 4
    top = ch.capped_result(assigned, 4)
    assert sorted(r.t for r in top.collect()) == [60, 70, 80, 90] and top.where("truncated").count() == 4


def test_pages_of_a_hot_second(spark):
    events = spark.createDataFrame([(i, 5 if i < 70 else i) for i in range(100)], "event_id long, t long")
    assigned = ch.assign_chunks(events, spark.createDataFrame([("1970-01-01", 0, 100)], "day string, start long, end long"))
    pages = {r.event_id: r.page for r in ch.paginate(assigned, 8, ["t", "event_id"]).collect()}
    assert pages == {i: i // 8 for i in range(100)}
    top = ch.capped_result(assigned, 40).collect()
    assert sorted(r.event_id for r in top) == sorted([*range(10), *range(70, 100)]) and all(r.truncated for r in top)


def test_exports_without_expected_count_are_counted(spark):
    events = spark.createDataFrame([(i, 10 * i) for i in range(10)], "event_id long, t long")
    rows = [("export", "done", 0, 50, None), ("job", "done", 50, 60, None), ("export", "done", 60, 100, 7), ("export", "split", 0, 100, None)]
    chunks = spark.createDataFrame([("1970-01-01", *r) for r in rows], "day string, mode string, status string, start long, end long, expected long")
    got = sorted(tuple(r)[1:] for r in ch.expect_exports(chunks, events).collect())
    assert got == sorted([("export", "done", 0, 50, 5), *rows[1:]])
