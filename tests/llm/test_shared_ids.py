"""Learning and keeping by row where ids are shared."""

import random

from pyspark.sql import functions as F
from tests.llm.helpers import frame, sentence

from eventlake.llm import jaccard, language, quality
from eventlake.llm.common import crc_remainder

ENGLISH, GERMAN = "the {} of the house with this and that there", "der {} und die Häuser nicht für zwölf große Bücher"


def learnable(spark, n):
    ids = spark.range(1, 400).where(crc_remainder(F.col("id"), 4) != 2).limit(n)
    return [r[0] for r in ids.collect()]


def test_language_of_rows_that_share_an_id(spark, monkeypatch):
    one, *others = learnable(spark, 120)
    rows = [(one, (ENGLISH if k % 2 else GERMAN).format(k), "en" if k % 2 else "de", "s", 1) for k in range(5000)]
    rows += [(one, GERMAN.format("x"), None, "s", 1)] * 50
    rows += [(i, (ENGLISH if k % 2 else GERMAN).format(i), "en" if k % 2 else "de", "s", 1) for k, i in enumerate(others)]
    seen = []
    monkeypatch.setattr(language, "train", lambda data, labels, n, s: seen.append((data, labels)) or language.start(n, s))
    model = language.learn(frame(spark, rows))
    (data, labels), = seen
    assert model.languages == ["de", "en"] and len(data) <= 2 * 150 * 4
    # Every window is labelled with the language of its own row.
    english = [b"the " in bytes(d) or b"that" in bytes(d) for d in data]
    assert [bool(x) for x in labels] == english
    few = language.learn(frame(spark, [(i, f"text of {i}", f"l{i:03d}", "s", 1) for i in others]), language.Settings(most_rows=5, steps=1))
    assert len(few.languages) == 5 and few.languages == sorted(f"l{i:03d}" for i in others)[:5]


def test_bands_of_rows_that_share_an_id(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(7, sentence(rng, 60) + str(k), "en", "s", 1) for k in range(1500)] + [(i, sentence(rng, 80), "en", "s", 1) for i in range(100, 260)]
    labels = spark.createDataFrame([(i, 1, 0) for i in {r[0] for r in rows}], "doc_id long, quality int, toxic int")
    counts = []
    fit = quality.fit_band
    monkeypatch.setattr(quality, "fit_band", lambda sizes, *rest: counts.append(len(sizes)) or fit(sizes, *rest))
    assert set(quality.learn(frame(spark, rows), labels)) == {None, "en"} and counts == [161, 161]


def test_keep_one_row_of_repeats(spark):
    copy, other = "one two three four five six seven", "quite another text that has its own words"
    chain = "red orange yellow green blue indigo violet"
    rows = [(i, t, "en", "s", 1) for i, t in [(5, copy)] * 4 + [(9, copy), (5, other), (5, other), (7, chain), (7, chain), (8, chain), (None, chain[:20]), (None, chain[:20]), (3, None), (3, None), (3, "")]]
    kept = sorted(str((r.doc_id, r.text)) for r in jaccard.keep_one(frame(spark, rows), repeats=False).collect())
    expected = [(5, copy), (5, other), (7, chain), (None, chain[:20]), (3, None), (3, None), (3, "")]
    assert kept == sorted(map(str, expected))
    assert jaccard.keep_one(frame(spark, rows)).count() == len(expected) + 3 + 1 + 1
    # Near copies under one id are one class: one row stays.
    long = " ".join(f"w{i}" for i in range(60))
    near = [(1, long, "en", "s", 1), (1, long + " tail", "en", "s", 1), (2, long + " end", "en", "s", 1)]
    assert [r.doc_id for r in jaccard.keep_one(frame(spark, near), repeats=False).collect()] == [1]
