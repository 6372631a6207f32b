import math
import re
from collections import Counter

import numpy as np
import pytest
from tests.llm.helpers import empty, frame, odd_rows, sentence

from eventlake.llm import ranked as rk

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    lists = [Counter(terms(t)) for t in docs["text"]]
    sizes = [sum(c.values()) for c in lists]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in lists for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c, size in zip(docs["ids"], lists, sizes):
            m = 100 - 90 + (90 * size * n) // max(1, total)
            score = 0
            for t in set(terms(text)) & set(c):
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort(key=lambda s: s[:3])
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def tables(spark):
    import random

    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = odd_rows()
    for i in range(700):
        picked = [words[min(59, int(rng.expovariate(0.08)))] for _ in range(rng.randint(1, 60))]
        rows.append((1000 + i if i % 50 else None, " ".join(picked), "en", "s1", 1))
    rows += [(2000, "w1, W2;w3", "en", "s1", 1)] * 15 + [(3000 - i, "w50 w51 w59", None, None, 1) for i in range(20)]
    items = [(1, "w1 w2 w3 W3"), (2, "w50 w51 w59"), (2, "w0 w1 w5 w9 w40 w41 w42 w58"), (3, None), (4, ""), (5, "nothing known here"), (None, "w7 w59"), (6, sentence(rng, 5))]
    items += [(7, " ".join(words)), (8, "one two three four"), (9, rows[10][1])]
    return rows, items


SMALL = rk.Search(shard_docs=100, block=3, window=17)


@pytest.mark.parametrize("rules", [rk.Search(), SMALL, rk.Search(shard_docs=64, shard_bytes=3000, block=5, window=64, round_terms=20), rk.Search(k=3, block=8, window=50)])
def test_ranked_search(spark, rules):
    rows, items = tables(spark)
    asked = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, shard string, score long")
    got = rk.rank(frame(spark, rows), asked, rules).collect()
    docs = {"ids": [r[0] for r in rows], "text": [r[1] for r in rows]}
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, items, rules.k)


def test_ranked_search_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert rk.rank(empty(spark), items).collect() == []
    assert rk.rank(frame(spark, odd_rows()), items.limit(0)).collect() == []
    none = frame(spark, [(1, None, None, None, None), (2, " -- ", None, None, None)])
    assert rk.rank(none, items).collect() == []


def test_pack_round_trip():
    values = np.r_[0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**34, np.arange(300)]
    raw, length = rk.pack(values)
    assert len(raw) == length.sum() and (rk.unpack(raw) == values).all()


def test_blocks_are_rejected_unread():
    """Of a long list that is not essential, only blocks with candidates are decompressed."""
    rng = np.random.default_rng(1)
    n = 5000
    sizes = rng.integers(5, 50, n)
    shard = rk._Shard(np.array([1, 2], np.uint64), SMALL)
    shard.docs, shard.sizes, shard.ids = n, [sizes], [__import__("pyarrow").array(np.arange(n))]
    rare = np.sort(rng.choice(n, 40, replace=False))
    shard.parts = [(np.r_[np.zeros(n, int), np.ones(40, int)], np.r_[np.arange(n), rare], np.ones(n + 40, int))]
    _, terms_ = shard.rows(0)
    factor = rk.length_factor(sizes, n, int(sizes.sum()))
    lists, read = [], []
    for i, weight in ((0, 1), (1, 5000)):
        row = {c: np.array(terms_.column(c)[i].values).astype(np.int64) for c in ("last", "most", "least", "ends")}
        row["payload"] = np.frombuffer(terms_.column("payload")[i].as_buffer(), np.uint8)
        lists.append(rk._List(weight, row, factor, rk.length_factor(row["least"], n, int(sizes.sum()))))
    plain = lists[0].read
    lists[0].read = lambda a, b: read.append(b - a) or plain(a, b)
    docs, _ = rk.best_of_shard(lists, n, np.arange(n), rk.Search(block=3, window=100))
    assert set(docs) <= set(rare) and sum(read) < len(lists[0].last) / 2
