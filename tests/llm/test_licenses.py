import random
import re

import pytest
from tests.llm.helpers import empty, frame, odd_rows

from eventlake.llm import licenses as lc

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(text, rules):
    """One document by loops: every block against every template."""
    words = TERM.findall((text or "").translate(LOWER))
    places, base = [], set()
    for phrase, label in rules.phrases:
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    sets = []
    for label, t in rules.templates:
        t = TERM.findall(t.translate(LOWER))
        if t:
            sets.append((label, set(t), next((w for w in rules.widths if w >= 2 * len(t)), rules.widths[-1])))
    labels, share = set(base), 0.0
    for width in {w for _, _, w in sets}:
        for at in range(0, len(words), width // 2):
            block = set(words[at : at + width])
            hits = [(label, s) for label, s, w in sets if w == width and 100 * len(s & block) >= rules.percent * len(s)]
            for label, s in hits:
                if not any(s < other for _, other in hits):
                    labels.add(label)
                    share = max(share, len(s & block) / len(s))
    score = 1.0 if places else share
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def notices(seed=2):
    rng = random.Random(seed)
    filler = "the of and under a in 0 2 license terms public ÄB é work".split()
    out = ["UNDER THE MIT LICENSE under the mit license", "under the\nMIT-License", "cc by-nc cc by nc", "Apache License; Version 2.0", "mit license", "İ under the mit license K"]
    for _, text in lc.TEMPLATES:
        words = TERM.findall(text.translate(LOWER))
        for drop in range(3):
            kept = [w for i, w in enumerate(words) if i not in rng.sample(range(len(words)), min(drop, len(words)))]
            if drop == 2:
                rng.shuffle(kept)
            out.append(" ".join([*rng.choices(filler, k=rng.randint(0, 40)), *kept, *rng.choices(filler, k=rng.randint(0, 300))]))
    out += [" ".join(rng.choices(filler, k=n)) for n in (1, 7, 8, 9, 500)] + [" / ".join(t for _, t in lc.TEMPLATES)]
    return out


@pytest.mark.parametrize("rules", [lc.Scan(), lc.Scan(percent=60, widths=(8, 32)), lc.Scan(templates=(), phrases=())])
def test_license_scan(spark, rules):
    rows = odd_rows() + [(700 + i, t, "en", "s1", 1) for i, t in enumerate(notices())] * 2
    got = sorted((tuple(r) for r in lc.label_documents(frame(spark, rows), rules).collect()), key=str)
    assert got == sorted([(r[0], *plain(r[1], rules)) for r in rows], key=str)


def test_license_scan_of_an_empty_table(spark):
    assert lc.label_documents(empty(spark)).collect() == []


def test_lesser_license_is_not_the_general_one(spark):
    texts = ["under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "This work is licensed under the\nGNU General Public License, version 3.", "All rights reserved.", "all the rights we reserved were"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in lc.label_documents(frame(spark, rows)).collect()}
    assert [v[0] for _, v in sorted(got.items())] == ["lgpl", "gpl-3", "all-rights-reserved", "all-rights-reserved"]


def test_templates_have_a_bound():
    with pytest.raises(ValueError):
        lc.templates_of(lc.Scan(most_words=10))
