"""Links at the threshold between documents that both have close copies, whose trie nodes may stop early."""

import random

from tests.llm.helpers import frame

from eventlake.llm import jaccard


def families(n, seed=6):
    """Two pairs of close copies (0.98) each, which 0.80 links."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    rows = []
    for f in range(n):
        a = [word() for _ in range(104)]
        b = a[:93] + [word() for _ in range(11)]
        for k, text in enumerate((a, [*a[:-1], word()], b, [word(), *b[1:]])):
            rows.append((4 * f + k, " ".join(text), "en", "s", 1))
    return rows


def test_links_beside_close_copies(spark):
    rows = families(250)
    grams = [{tuple(r[1].split()[i : i + 5]) for i in range(100)} for r in rows]
    wanted = sum(len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j]) for f in range(250) for i in range(4 * f, 4 * f + 4) for j in range(i + 1, 4 * f + 4))
    assert wanted == 4 * 250
    found = sum(r.n_links for r in jaccard.classes(frame(spark, rows)).collect()) / 2
    assert 0.995 * wanted <= found <= wanted


def test_bytes_of_a_call_with_long_texts(spark, monkeypatch):
    """Small trie nodes of long texts are dealt to calls by bytes too, not by rows alone."""
    rng = random.Random(3)
    rows = []
    for k in range(30):
        a = [str(rng.randrange(10**9)) for _ in range(4000)]
        rows += [(2 * k, " ".join(a), "en", "s", 1), (2 * k + 1, " ".join([*a[:-1], "end"]), "en", "s", 1)]
    rules, work = jaccard.Forest(block_bytes=200_000), jaccard._cells

    def bounded(rules, depth):
        inner, most = work(rules, depth), 2 * rules.block_bytes

        def call(part):
            assert part["shingles"].str.len().sum() <= most
            return inner(part)

        return call

    monkeypatch.setattr(jaccard, "_cells", bounded)
    assert [tuple(r) for r in jaccard.classes(frame(spark, rows), rules).select("doc_id", "class_id", "n_links").orderBy("doc_id").collect()] == [(i, i - i % 2, 1) for i in range(60)]
