"""Small tables with every awkward row: nulls, empty and long texts, repeats, and clashing extra columns."""

from __future__ import annotations

import random
import re

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "h string, size long, node long, key long, label long, score double, n long, words binary, kept boolean, doc long"
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(n))


def odd_rows(seed=1):
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(60, 140)) for _ in range(12)]
    passage = sentence(rng, 70)
    texts = [None, "", " \n\t ", "one", "one two three four", "one two three four", "x" * 5000, "ab " * 3000]
    texts += base + [base[0], base[0] + " tail", base[1].replace(" ", "\n", 3)]
    texts += [f"{base[2]} {passage} {base[3]}", f"{passage} {base[4]}", f"start {passage}", sentence(rng, 6000)]
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None, ""][i % 4], len(t) if t else None) for i, t in enumerate(texts)]
    rows += [rows[10], (None, base[5], "en", "s1", 1), (None, None, None, None, None), (500, "Ünï " * 40, "fr", "s9", 3)]
    return rows


def frame(spark, rows):
    extra = ("x", 1, 2, 3, 4, 0.5, 6, bytearray(b"w"), True, 7)
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA)


def odd(spark):
    return frame(spark, odd_rows())


def empty(spark):
    return frame(spark, odd_rows()).limit(0)
