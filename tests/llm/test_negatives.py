import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake.llm import negatives as ng

SCHEMA = "vec_id long, embedding array<double>, label long, n long, dim int, row string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)


def brute(rows, step, positives=5, negatives=5):
    """By plain Python integers."""
    best = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        if sum((abs(256 * x) + 1) * (abs(256 * x) + 1) for x in v) >= 2**62:
            continue
        row = ([int(np.floor(256 * x)) for x in v], label)
        best[i] = min(best.get(i, row), row)
    out = []
    for a, (va, la) in best.items():
        if a % step:
            continue
        scored = [(-sum(x * y for x, y in zip(va, vb)), b, lb) for b, (vb, lb) in best.items() if b != a and len(vb) == len(va)]
        scored.sort()
        for p, pid, _ in [s for s in scored if s[2] == la][:positives]:
            fits = [s for s in scored if s[2] != la and 80 * -p <= 100 * -s[0] <= 100 * -p][:negatives]
            out += [(a, pid, rank, n, -p, -s) for rank, (s, n, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, step, rules):
    coded = ng.encode(table(spark, rows), F.col("vec_id"), F.col("label"), F.col("embedding"), rules)
    return sorted(tuple(r) for r in ng.mine(coded, coded.where(F.col("vec_id") % step == 0), rules).collect())


def odd_rows():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 6))
    rows = [(i, [float(x) for x in centres[i % 4] + rng.normal(size=6) * 0.4], int(rng.integers(3))) for i in range(150)]
    rows += [(200 + i, list(rows[3][1]), i % 3) for i in range(40)]  # ties
    rows += [(300 + i, [1e5 * (i + 1), -2e5], i % 2) for i in range(12)]  # long scores
    rows += [(400, None, 1), (401, [1.0, None], 1), (402, [float("nan")] * 6, 1), (403, [float("inf")] * 6, 1), (404, [0.5] * 6, None)]
    rows += [(None, [0.5] * 6, 1), (410, [1e300] * 6, 1), (412, [1e10] * 6, 1), (420, [], 1), (430, [], 2), (440, [], 1), (450, [0.0] * 6, 1)]
    rows += [rows[0], rows[0], (0, [float(x) for x in -centres[0]], 1)]
    return rows


@pytest.mark.parametrize("rules", [ng.Mining(), ng.Mining(anchor_rows=7, candidate_rows=20, least_rows=9, tile_anchors=3, tile_candidates=8)])
def test_hard_negatives(spark, rules):
    rows = odd_rows()
    got = mined(spark, rows, 10, rules)
    assert got == brute(rows, 10) and len(got) > 100


def test_hard_negatives_of_few(spark):
    assert mined(spark, [(0, [1.0], 1)], 10, ng.Mining()) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)], 10, ng.Mining()) == [(0, 1, 1, 2, 65536, 58880)]
    assert mined(spark, [], 10, ng.Mining()) == []


@pytest.mark.parametrize("size", [3, 1000, 2**20, 2**30])
def test_products_are_exact(size):
    rng = np.random.default_rng(size)
    dim = 2500 if size < 2**20 else 3
    a, b = rng.integers(-size, size + 1, (9, dim)), rng.integers(-size, size + 1, (11, dim))
    a[0], b[0] = size, -size
    assert (ng.integer_products(a.astype(np.int32), b.astype(np.int32)) == [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]).all()


def test_residues_span_the_integers():
    moduli = ng.primes()[:2]
    whole = np.arange(-(moduli[0] * moduli[1] - 1) // 2, moduli[0] * moduli[1] // 2 + 1)
    assert (ng.reconstruct(ng.residues(whole, moduli), moduli) == whole).all()
    assert len(ng.primes_for(2.0**62)) == 8
