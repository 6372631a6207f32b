"""Factors of the grammar are learned: against a plain posterior, and by what each changes on held-out texts."""

import random
from dataclasses import replace
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.helpers import frame

from eventlake.llm import toxicity as tox
from eventlake.llm.common import crc_remainder

#: No part says anything yet: what it means must come from the labels.
BLANK = tox.Grammar(targeted=1.0, negated=1.0, reported=1.0, threat=0.5, prior=1.5, tried=(-5, 2, 2))
KINDS = {
    "you are an {i} and more": 1, "{i} you": None, "this is an {i} of a thing": None, "not an {i} here": 0, "he is never an {i} at all": 0, "people said {i} about it": 0,
    "someone wrote that {i} {i}": 0, "we will {t} you": 1, "to {t} a process": 0, "nothing of interest": 0,
}


def planted(n=1200, seed=8):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        kind, label = rng.choice(list(KINDS.items()))
        text = kind.format(i=rng.choice(tox.SEEDS[tox.INSULT].split()), t=rng.choice(["kill", "hurt", "destroy"]))
        toxic = label if label is not None else int(rng.random() < 0.6)
        rows.append((i, f"some words. {text}! other words {i}", "en", "s", 1))
        labels.append((i, 1, toxic if rng.random() > 0.03 else 1 - toxic))
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels = planted()
    rules = replace(BLANK, least_rows=10_000)  # no patterns: seed words only
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    held = {r[0] for r in spark.range(len(rows)).where(crc_remainder(F.col("id"), 4) == 2).collect()}
    return rules, rows, {i: t for i, _, t in labels}, held, tox.learn(docs, marks, rules)


def plain_posterior(factors, rows, truth, held, rules, lexicon):
    made = tox.machine(replace(rules, **factors))
    total = -sum((log(factors[n] / getattr(rules, n))) ** 2 for n in tox.FACTORS) / (2 * rules.prior**2)
    for i, text, *_ in rows:
        if i not in held:
            raw = np.frombuffer(text.encode(), np.uint8)
            score, _ = tox.score_texts(raw, np.array([0, len(raw)]), lexicon, made, rules)
            p = min(max(score[0], 1e-6), 0.999)
            total += log(p if truth[i] else 1 - p)
    return total


def test_factors_have_the_highest_posterior(learned):
    rules, rows, truth, held, lexicon = learned
    best = plain_posterior(lexicon.factors, rows, truth, held, rules, lexicon)
    for name in tox.FACTORS:
        for k in range(-6, 7, 2):
            other = lexicon.factors | {name: lexicon.factors[name] * 2 ** (k / 2)}
            assert plain_posterior(other, rows, truth, held, rules, lexicon) <= best + 1.0, (name, k)
    assert lexicon.factors["negated"] < 0.3 and lexicon.factors["reported"] < 0.3 and lexicon.factors["targeted"] > 1.2 and lexicon.factors["threat"] > 0.6


@pytest.mark.parametrize("name", tox.FACTORS)
def test_each_part_changes_verdicts_for_the_better(spark, learned, name):
    rules, rows, truth, held, lexicon = learned
    docs = frame(spark, [r for r in rows if r[0] in held])

    def wrong(lexicon):
        got = tox.scores(docs, lexicon, rules).collect()
        return sum(r.predicted != truth[r.doc_id] for r in got)

    without = replace(lexicon, factors=lexicon.factors | {name: 1.0 if name != "threat" else 0.01})
    if name == "targeted":  # what a target adds is seen in the score
        raw = [np.frombuffer(t.encode(), np.uint8) for t in ("you idiot", "an idiot")]
        score = lambda x, t: tox.score_texts(t, np.array([0, len(t)]), x, tox.machine(x.tuned(rules)), rules)[0][0]
        assert score(lexicon, raw[0]) > score(lexicon, raw[1]) == score(without, raw[1]) == score(without, raw[0])
    else:
        assert wrong(lexicon) < wrong(without)
    assert wrong(lexicon) <= 0.2 * len(held)


def test_without_evidence_factors_stay(spark):
    rules = tox.Grammar()
    docs = frame(spark, [(i, f"plain text number {i}", "en", "s", 1) for i in range(40)] + [(i, "scumbag", "en", "s", 1) for i in range(40, 60)])
    labels = spark.createDataFrame([(i, 1, int(i >= 40)) for i in range(60)], "doc_id long, quality int, toxic int")
    assert tox.learn(docs, labels, rules).tuned(rules) == rules
