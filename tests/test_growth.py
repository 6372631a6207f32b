import random

import pytest
from pyspark.sql import functions as F

from eventlake.operators import chunks as ch
from eventlake.operators import count_tree as ct
from eventlake.operators import differences as df_
from eventlake.operators import interval_merge as im
from eventlake.operators import planning

D = 1534723200


def table(spark, n=3000, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = D + (rng.randrange(3 * 86400) if i % 3 else 40_000 + rng.randrange(3))
        rows.append((i, t, t + rng.randrange(5 * 3600)))
    return spark.createDataFrame(rows, "event_id long, t long, _indextime long"), rows


def test_covers_tile_their_ranges(spark):
    rng = random.Random(2)
    ranges = [(0, 0, 86400), (1, 5, 6), (2, 0, 86401), (3, 7, 7), (4, -5, 100_000)]
    ranges += [(k, a := rng.randrange(-10_000, 300_000), a + rng.randrange(1, 400_000)) for k in range(5, 60)]
    got = {}
    for r in ct.cover(spark.createDataFrame(ranges, "id long, start long, end long")).collect():
        got.setdefault(r.id, []).append((r.node, r.node + r.span))
    for i, a, b in ranges:
        nodes = sorted(got.get(i, []))
        assert [x for x, _ in nodes] + ([b] if nodes else []) == ([a] if nodes else []) + [y for _, y in nodes]
        assert (sum(y - x for x, y in nodes), len(nodes) < 140) == (max(0, b - a), True)


def test_counts_for_any_pin_as_the_table_grows(spark, tmp_path):
    events, rows = table(spark)
    path, edges = str(tmp_path / "tree"), [0, D + 90_000, D + 180_000, 1 << 40]
    rng = random.Random(3)
    for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
        batch = events.where((F.col("_indextime") >= lo) & (F.col("_indextime") < hi))
        ct.grow(batch, path, str(k), 3600)
        ct.grow(batch, path, str(k), 3600)  # a batch that is run again replaces itself
        asked = []
        for i in range(12):
            a = D + rng.randrange(-5000, 3 * 86400)
            pin = D // 3600 * 3600 + 3600 * rng.randrange(80)
            asked.append((i, a, a + rng.choice([1, 50, 5000, 90_000, 300_000]), rng.choice([None, pin]), rng.choice([None, pin - 7200])))
        sums = ct.prefixes(ct.read_tree(spark, path))
        got = {r.id: (r.n, r.late) for r in ct.counts_at(sums, spark.createDataFrame(asked, "id long, start long, end long, pin long, old_pin long"), 3600).collect()}
        seen = [r for r in rows if r[2] < hi]
        for i, a, b, pin, old in asked:
            under = [r for r in seen if a <= r[1] < b and (pin is None or r[2] < pin)]
            assert got[i] == (len(under), sum(r[2] >= old for r in under) if old is not None else 0)
    with pytest.raises(ValueError, match="multiples"):
        ct.counts_at(sums, spark.createDataFrame([(1, 0, 9, 7, None)], "id long, start long, end long, pin long, old_pin long"), 3600)


@pytest.mark.parametrize("span,least,shift", [(3600, 1, 0), (600, 7, 1234)])
def test_plans_follow_growth(spark, tmp_path, span, least, shift):
    events, _ = table(spark, 1500)
    path, lo, hi = str(tmp_path / "tree"), D + shift, D + 3 * 86400 - shift
    steps = [events.where("_indextime < 1534800000"), events.where("_indextime >= 1534800000 AND t < 1534850000"), events.where("_indextime >= 1534800000 AND t >= 1534850000")]
    bins = plan = None
    ranges = spark.createDataFrame([(lo, hi)], "start long, end long")
    for k, batch in enumerate(steps):
        ct.grow(batch, path, str(k), 60)
        tree = ct.read_tree(spark, path)
        if bins is None:
            bins = planning.refine_seconds(ct.seconds_of(tree), lo, hi, span, 20, least)
            plan = planning.pack(bins, ranges, 20)
        else:
            added = tree.where(F.col("batch") == str(k))
            bins = ct.refine_again(bins, tree, added, lo, hi, span, 20, least)
            plan = ct.pack_again(plan, bins, added, lo, hi, 20)
        bins, plan = (spark.createDataFrame(x.collect(), x.schema) for x in (bins, plan))
        whole = planning.refine_seconds(ct.seconds_of(tree), lo, hi, span, 20, least)
        assert sorted(map(tuple, bins.collect())) == sorted(map(tuple, whole.collect()))
        assert sorted(map(tuple, plan.collect())) == sorted(map(tuple, planning.pack(whole, ranges, 20).collect()))
    # Only bins of the last batch are looked at: others stay, right or wrong.
    wrong = bins.withColumn("count", F.when(F.col("end") < 1534800000, -1).otherwise(F.col("count")))
    after = ct.refine_again(wrong, tree, tree.where("batch = '2'"), lo, hi, span, 20, least)
    assert after.where("count = -1").count() == wrong.where("count = -1").count() > 0


def test_slots_follow_short_chunks(spark):
    seconds = spark.createDataFrame([("2018-08-20", D + s, D + s + 1) for s in range(20_000)], "day string, start long, end long")
    named = seconds.select(F.col("start").alias("chunk_start"), F.col("end").alias("chunk_end"))
    assert ch._slots(named) == (1, 20_000)  # in hours, each event would be compared with 3,600 chunks
    days = spark.range(3000).select((F.col("id") * 86400).alias("chunk_start"), (F.col("id") * 86400 + 86400).alias("chunk_end"))
    assert ch._slots(days) == (3600, 72_000) and ch._slots(days.limit(0))[1] == 0
    events, _ = table(spark)
    some = seconds.where("start % 3 > 0").unionByName(spark.createDataFrame([("2018-08-20", D + 20_000, D + 86400), ("2018-08-21", D + 86400, D + 172_800)], "day string, start long, end long"))
    pick = lambda df: sorted(tuple(r) for r in df.select("event_id", "chunk_start", "chunk_end").collect())
    assert pick(ch.assign_chunks(events, some)) == pick(im.merge_chunks(events, some))


@pytest.mark.parametrize("parts", [1, 2, 7, 64])
def test_interval_merge_is_the_hash_join(spark, parts):
    events, rows = table(spark)
    events = events.withColumns({"part": F.lit(1), "at": F.lit("x"), "kind": F.lit(2), "row": F.col("event_id"), "chunk": F.lit(None).cast("string"), "m": F.create_map(F.lit("k"), F.lit("v"))})
    events = events.unionByName(events.limit(1).withColumn("t", F.lit(None).cast("long")))
    rng = random.Random(parts)
    edges = sorted({D + rng.randrange(3 * 86400) for _ in range(90)} | {D + 86400, D + 2 * 86400, D + 40_000, D + 40_001})
    chunks = [(f"2018-08-{20 + (a - D) // 86400}", a, b, k) for k, (a, b) in enumerate(zip(edges, edges[1:])) if k % 5]
    chunks = spark.createDataFrame([*chunks, ("2018-08-20", D, D, -1)], "day string, start long, end long, id long")
    merged = im.merge_chunks(events, chunks, ("id", "start", "end"), parts)
    joined = ch.assign_chunks(events, chunks, keys=("id", "start", "end"))
    assert merged.columns == joined.columns
    pick = lambda df: sorted(tuple(r) for r in df.select("event_id", "t", "chunk_id", "chunk_start", "chunk_end", "row", "kind").collect())
    assert pick(merged) == pick(joined) and merged.count() > 1000
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan
    assert im.merge_chunks(events.limit(0), chunks).count() == 0 and im.merge_chunks(events, chunks.limit(0)).count() == 0


def test_a_hot_second_is_spread(spark):
    events = spark.range(4000).select(F.col("id").alias("event_id"), F.when(F.col("id") % 2 == 0, 500).otherwise(F.col("id")).alias("t"))
    bounds = im.bounds_of(events, 10)
    assert bounds.count(500) >= 4
    chunk = spark.createDataFrame([("d", 0, 10_000)], "day string, start long, end long")
    assert im.merge_chunks(events, chunk, parts=10).count() == 4000


def lines(spark, rows):
    return spark.createDataFrame(rows, "key string, line string")


def test_digest_trees_find_one_line(spark, monkeypatch):
    rows = [("a", f"line {i}") for i in range(5000)] + [("b", "x"), ("b", "x"), ("c", None)]
    one, two = lines(spark, rows), lines(spark, [("a", "line 77 "), *rows[:77], *rows[78:]]).repartition(3)
    trees = [df_.digest_tree(x, ["key"]) for x in (one, two)]
    roots = [{r.key: (r.rows, r.digest) for r in df_.root_digests(t, ["key"]).collect()} for t in trees]
    assert roots[0]["b"] == roots[1]["b"] and roots[0]["c"] == roots[1]["c"] and roots[0]["a"] != roots[1]["a"] and roots[0]["a"][0] == 5000
    kept = []
    keep = df_.keep
    monkeypatch.setattr(df_, "keep", lambda df, name: kept.append(keep(df, name)) or kept[-1])
    leaves = df_.different_leaves(*trees, ["key"])
    assert [k.count() <= 2 for k in kept] == [True] * (df_.LEVELS + 1)  # of up to 5,000 leaves
    got = {(r.key, r.line, r.off) for r in df_.different_lines(one, two, leaves, ["key"]).collect()}
    assert got == {("a", "line 77", 1), ("a", "line 77 ", -1)}
    again = df_.different_leaves(trees[0], df_.digest_tree(one.repartition(9), ["key"]), ["key"])
    assert again.count() == 0
    # A repeated line, and a key that only one side has.
    more = lines(spark, [*rows, ("b", "x"), ("d", "new")])
    leaves = df_.different_leaves(trees[0], df_.digest_tree(more, ["key"]), ["key"])
    assert {(r.key, r.line, r.off) for r in df_.different_lines(one, more, leaves, ["key"]).collect()} == {("b", "x", -1), ("d", "new", -1)}
    assert df_.digest_tree(one.limit(0), ["key"]).count() == 0


def test_chunk_states_after_restarts(spark, tmp_path):
    import datetime as dt

    from eventlake.streaming import completeness as cs

    schema = "chunk string, ts timestamp, preview boolean, lastrow boolean, malformed boolean, has_result boolean"
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    batches = [
        [("a", at(0), False, False, False, True), ("b", at(1), False, False, False, True), ("a", at(2), True, True, False, True), ("e", at(3), None, True, None, False)],
        [("a", at(50), False, True, False, True), ("c", at(60), False, False, False, True), ("c", at(61), False, False, True, False)],
        [("d", at(130), False, False, False, True), ("f", at(131), False, True, True, True)],
        [("d", at(400), False, True, False, True)],
    ]
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    seen = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):  # started again without anything new
            cs.start(cs.chunk_states(spark.readStream.schema(schema).parquet(source), 100, "10 seconds"), out, state).awaitTermination()
        seen.append({(r.chunk, r.rows, r.malformed, r.state) for r in spark.read.schema(cs.OUTPUT).parquet(out).collect()})
    assert seen[0] == {("e", 0, 0, "complete")} and seen[1] == seen[0] | {("a", 2, 0, "complete")}
    assert seen[2] == seen[1] | {("b", 1, 0, "failed"), ("f", 1, 1, "failed")}
    assert seen[3] == seen[2] | {("c", 1, 1, "failed"), ("d", 2, 0, "complete")}
    assert spark.read.schema(cs.OUTPUT).parquet(out).count() == len(seen[3])
