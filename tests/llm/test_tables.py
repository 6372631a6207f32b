"""Operators that give one row per document: against brute force on awkward rows."""

import hashlib
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest

from eventlake.llm import bloom_lm, jaccard, mixing, quality, substrings
from tests.llm.helpers import empty, frame, odd_rows, words


def crc(doc_id, m):
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"") % m


# -- 2 ------------------------------------------------------------------------------------------


def targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    goal, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 3 * sizes[s]]
        if not over:
            return goal | {s: level * weight[s] for s in open_}
        for s in over:
            goal[s] = 3.0 * sizes[s]
            left -= goal[s]
            open_.remove(s)
    return goal


def test_mixing(spark):
    rows = [r for r in odd_rows() if r[0] != 7]
    got = mixing.mix(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        n = len(words(r[1]))
        sizes[r[3]] += n
        largest[r[3]] = max(largest[r[3]], n)
    goal = targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
        assert 0 <= r.copies <= 3 and (r.size > 0 or r.copies == 0)
        taken[r.source] += r.copies * r["size"]
    assert all(abs(taken[s] - goal[s]) <= 2 * largest[s] for s in sizes)
    again = mixing.mix(frame(spark, rows[::-1]).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixing_repeats_rows(spark):
    docs = frame(spark, [r for r in odd_rows() if r[0] not in (10, None)])
    counts = {(r.doc_id, r.h): r.copies for r in mixing.mix(docs).collect()}
    mixed = mixing.apply_mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(counts.values())


def test_mixing_empty(spark):
    assert mixing.mix(empty(spark)).count() == 0 and mixing.apply_mix(empty(spark)).count() == 0


# -- 3 ------------------------------------------------------------------------------------------


def base_rules(text):
    w = words(text)
    text = text or ""
    lines = [x for x in text.split("\n") if words(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            hit |= set(range(i, i + 8))
    failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed


def test_quality(spark):
    extra = [(900, "a b\nc d\na b\n \na b", "en", "s", 1), (901, "#x & y|" * 9, "en", "s", 1), (902, "w1 w2 w3 w4 w5 w6 w7 w8 w9 " * 2 + "z " * 3, "en", "s", 1)]
    rows = odd_rows() + extra
    got = quality.judge(frame(spark, rows)).collect()
    key = lambda r: (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
    assert sorted(map(str, map(key, got))) == sorted(str((r[0], *base_rules(r[1]))) for r in rows)
    assert not any(r.kept for r in got if r.base_failed)
    assert quality.judge(empty(spark)).count() == 0


def test_compression_bands():
    rng = np.random.default_rng(1)
    random_text = "".join(chr(c) for c in rng.integers(33, 127, 6000)).encode()
    prose = b"The committee met on Tuesday to discuss the annual report, and several members raised questions about spending. "
    mixed = prose + b"Later in the week a second hearing covered road repairs, school meals, and the new library roof; nobody objected. "
    texts = [random_text, prose * 40, mixed + b"A vote is due in spring.", mixed * 2 + random_text * 3]
    offsets = np.cumsum([0, *map(len, texts)])
    _, bad, good = quality.compression(np.frombuffer(b"".join(texts), np.uint8), offsets, quality.Bands())
    assert good.tolist() == [False, False, True, False] and bad[3] > 0.25


def plain_verdict(text, lang, bands, learned):
    """The verdict of one text by the rules' words, one compression at a time."""
    import math

    import zstandard

    raw = (text or "").encode()
    if base_rules(text)[-1]:
        return False
    ratio = lambda b: len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(b)) / len(b)
    if len(raw) < 128:
        return True
    rules = learned.get(lang, learned[None])
    x = math.log2(len(raw))
    inside = min(max(x, rules.knots[0]), rules.knots[-1])
    a, b, c = rules.curve
    middle = a * inside**2 + b * inside + c + (2 * a * inside + b) * (x - inside)
    least = middle + np.interp(inside, rules.knots, rules.below) - rules.widening * abs(x - inside)
    most = middle + np.interp(inside, rules.knots, rules.above) + rules.widening * abs(x - inside)
    ok = least <= ratio(raw) <= most
    if len(raw) >= 1024:
        cuts = list(range(0, len(raw), 2048))
        if len(cuts) > 1 and len(raw) - cuts[-1] < 1024:
            cuts.pop()
        parts = [raw[i:j] for i, j in zip(cuts, [*cuts[1:], len(raw)])]
        outside = sum(len(p) for p in parts if not rules.chunk[0] <= ratio(p) <= rules.chunk[1])
        ok = ok and outside <= 0.25 * len(raw)
    return ok


def test_learned_bands(spark):
    """All documents of sf0.01 against a plain loop; held-out labels; planted junk in good documents."""
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    learned = quality.learn(docs, labels.where(~fold))
    assert None in learned and all(isinstance(b, quality.Learned) for b in learned.values())
    got = {r.doc_id: r.kept for r in quality.judge(docs, learned=learned).collect()}
    rows = docs.select("doc_id", "text", "lang").collect()
    assert all(got[r.doc_id] == plain_verdict(r.text, r.lang, quality.Bands(), learned) for r in rows)
    noise = lambda t, i: " ".join(w + "*#$%"[(i + k) % 4] * 3 for k, w in enumerate(t.split()))
    good = [r for r in rows if got[r.doc_id] and len(r.text) > 1500]
    planted = [(r.doc_id, noise(r.text, r.doc_id), r.lang, None, 1) for r in good]
    planted += [(-r.doc_id, r.text + " " + np.random.default_rng(r.doc_id + 1).bytes(len(r.text)).hex(), r.lang, None, 1) for r in good]
    kept = quality.keep_good(frame(spark, planted), learned=learned)
    assert kept.columns == frame(spark, planted).columns and kept.count() <= 0.1 * len(planted)
    assert quality.keep_good(docs, learned=learned).count() == sum(got.values())


def test_learned_bands_held_out(spark):
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    judged = quality.judge(docs, learned=quality.learn(docs, labels.where(~fold))).join(labels.where(fold), "doc_id").where("NOT base_failed")
    n = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert n[0, False] >= 0.7 * (n[0, False] + n.get((0, True), 0)) and n.get((1, False), 0) <= 0.02 * n[1, True]


def test_bands_of_odd_tables(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(1, 1), (None, 1), (3, 0), (3, 1), (4, None)], "doc_id long, quality int")
    learned = quality.learn(docs, labels)
    assert list(learned) == [None]
    got = quality.judge(docs, learned=learned)
    assert got.count() == len(rows) and quality.keep_good(docs, learned=learned).count() == got.where("kept").count()
    assert quality.learn(empty(spark), labels.limit(0)) == {None: quality.Bands()} and quality.keep_good(empty(spark)).count() == 0
    assert quality.judge(docs.drop("lang")).count() == len(rows)


# -- 6 ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("settings", [bloom_lm.Settings(filter_bits=20), bloom_lm.Settings(filter_bits=16, head_words=40, bigram_words=20)])
def test_bloom_lm(spark, settings):
    rows = odd_rows()
    got = bloom_lm.score(frame(spark, rows), settings).collect()
    tokens = [(r[0], [w.translate({c: c + 32 for c in range(65, 91)}) for w in words(r[1])] + ["\0"]) for r in rows]
    c = Counter(w for i, t in tokens if crc(i, 10) for w in t)
    n, v = sum(c.values()), len(c)
    expected = []
    for i, t in tokens:
        base = sum(log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        expected.append((i, crc(i, 10) == 0, len(t), sum(c[w] > 0 for w in t), n, round(base, 6)))
    assert sorted(str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in got) == sorted(map(str, expected))
    assert all(np.isfinite(r.score) and r.score <= 0 for r in got)
    assert bloom_lm.score(empty(spark), settings).count() == 0


def plain_model(tokens):
    """Counts of words, bigrams and trigrams in the texts that may be learned from."""
    texts = [["<s>", *t] for i, t in tokens if crc(i, 10)]
    return [Counter(tuple(t[k : k + n]) for t in texts for k in range(len(t) - n + 1)) for n in (1, 2, 3)]


def plain_chance(word, context, model, middle, s):
    """The chance of a word behind one or two others; ``middle`` reads a count back as the filter does."""
    ones, twos, threes = model
    n = sum(c for (w,), c in ones.items() if w != "<s>")
    v = sum(w != "<s>" for (w,) in ones)
    p = ((ones[word,] if word != "<s>" else 0) + 0.1) / (n + 0.1 * (v + 1))
    before = ones[context[-1],]
    p = (min(middle(twos[context[-1], word]), before) + s.behind_pairs * p) / (before + s.behind_pairs)
    if len(context) > 1:
        before = middle(twos[context])
        p = (min(middle(threes[*context, word]), before) + s.behind_triples * p) / (before + s.behind_triples)
    return p


def plain_score(tokens, model, s):
    middle = lambda n: float(bloom_lm.restored(bloom_lm.quantised(np.array([n]), s.base), s.base)[0]) if n else 0.0
    t = ["<s>", *tokens]
    return sum(log10(plain_chance(t[k], tuple(t[max(0, k - 2) : k]), model, middle, s)) for k in range(1, len(t)))


def test_chances_sum_to_one():
    """With exact counts, behind any context; and nearly so with those that the filter would give."""
    tokens = [(i, words(t[1]) + ["</s>"]) for i, t in enumerate(near_rows())]
    model = plain_model(tokens)
    s = bloom_lm.Settings()
    vocabulary = [w for (w,) in model[0] if w != "<s>"] + ["never seen"]
    middle = lambda n: float(bloom_lm.restored(bloom_lm.quantised(np.array([n]), s.base), s.base)[0]) if n else 0.0
    common = [w for (w,), _ in model[0].most_common(3) if w != "</s>"]
    for context in [("<s>",), *((w,) for w in common), *(c for c, _ in model[1].most_common(6) if c[1] != "</s>"), ("not", "there")]:
        exact = sum(plain_chance(w, context, model, float, s) for w in vocabulary)
        assert exact == pytest.approx(1, abs=1e-9), context
        assert sum(plain_chance(w, context, model, middle, s) for w in vocabulary) == pytest.approx(1, abs=0.05), context


@pytest.mark.parametrize("settings", [bloom_lm.Settings(room=4096), bloom_lm.Settings(room=4096, bundle_tokens=300, least_segments=4, segment_tokens=500, head_words=40, bigram_words=20)])
def test_bloom_lm_leaves_nothing_out(spark, settings):
    """Scores are those of all words and bigrams, seen once or often, rare or frequent."""
    rows = odd_rows() + [(i, f"once{i} only{i} here the end", "en", "s", 1) for i in range(1000, 1040)]
    got = bloom_lm.score(frame(spark, rows), settings).collect()
    tokens = [(r[0], [w.translate({c: c + 32 for c in range(65, 91)}) for w in words(r[1])] + ["\0"]) for r in rows]
    expected = [(i, len(t), round(plain_score(t, plain_model(tokens), settings), 6)) for i, t in tokens]
    same = Counter(map(str, expected)) & Counter(str((r.doc_id, r.n_tokens, round(r.score, 6))) for r in got)
    assert len(got) == len(expected) and same.total() == len(expected)  # with so much room the filter does not err here


def test_log_filter(spark):
    rng = np.random.default_rng(4)
    grams = rng.integers(-(2**62), 2**62, 4000)
    n = rng.integers(1, 900, 4000)
    s = bloom_lm.Settings(filter_bits=20)
    df = spark.createDataFrame(list(zip(grams.tolist(), n.tolist())), "gram long, n long")
    made = bloom_lm.build_filter(df, s)
    read = made.levels(grams.view(np.uint64))
    true = bloom_lm.quantised(n, s.base)
    assert (read >= true).all() and (read > true).mean() < 0.01
    absent = made.levels(rng.integers(0, 2**62, 4000).astype(np.uint64))
    assert (absent > 0).mean() < 0.001
    assert bloom_lm.quantised(np.array([1, 2, 3, 4, 7, 8])).tolist() == [1, 2, 2, 3, 3, 4]


# -- 7 ------------------------------------------------------------------------------------------


def brute_links(rows):
    sets = []
    for r in rows:
        w = words(r[1])
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links, up = [0] * len(rows), list(range(len(rows)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                up[find(a)] = find(b)
    ids = [r[0] if r[0] is not None else -(1 << 63) for r in rows]
    least = defaultdict(lambda: 1 << 63)
    for i in range(len(rows)):
        least[find(i)] = min(least[find(i)], ids[i])
    low = lambda i: None if least[find(i)] == -(1 << 63) else least[find(i)]
    return [(rows[i][0], low(i), links[i]) for i in range(len(rows))]


def near_rows():
    """A large group of near copies, a chain, copies of one text, and others."""
    import random

    from tests.llm.helpers import sentence

    rng = random.Random(9)
    rows = odd_rows()
    base = sentence(rng, 120).split()
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(9999)}"
        rows.append((1000 + i, " ".join(w), "en", "s", 1))
    chain = sentence(rng, 100).split()
    for i in range(12):
        rows.append((2000 + i, " ".join(chain[i * 4 :] + [f"c{i}x{k}" for k in range(i * 4)]), "en", "s", 1))
    return rows


@pytest.mark.parametrize("rules", [jaccard.Forest(), jaccard.Forest(block=16)])
def test_jaccard_join(spark, rules):
    rows = near_rows()
    got = [(r.doc_id, r.class_id, r.n_links) for r in jaccard.classes(frame(spark, rows), rules).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_links(rows)))


def test_jaccard_join_of_many_rows_without_id(spark):
    rows = [(None if i % 2 else 7, r[1], *r[2:]) for i, r in enumerate(near_rows())]
    got = [(r.doc_id, r.class_id, r.n_links) for r in jaccard.classes(frame(spark, rows), jaccard.Forest(block=8, block_bytes=20_000)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_links(rows)))


def test_prefixes_are_shortened_where_recall_is_missing():
    rules = jaccard.Forest()
    p = [float(jaccard.shares_prefix(rules, np.array([0.8]), d)[0]) for d in (6, 5, 4)]
    assert p == pytest.approx([jaccard.recall_at(rules, d) for d in (6, 5, 4)]) and p[0] < p[1] < rules.recall <= p[2]
    assert jaccard.shares_prefix(rules, np.array([0.97]), 6)[0] > rules.recall  # close copies stop at the full depth


def test_settled_nodes(spark):
    rules = jaccard.Forest()
    missed = lambda s: [1 / float(jaccard.shares_prefix(rules, np.array([s]), d)[0]) - 1 for d in (6, 5)]
    rows = [(1, 3, [3 * m for m in missed(0.97)], 6), (2, 3, [3 * m for m in missed(0.82)], 6), (3, 0, [0.0, 0.0], 6), (4, 1, missed(0.9)[1:], 5)]
    found = spark.createDataFrame(rows, "node long, pairs long, missed array<double>, depth int")
    assert {r.node for r in jaccard._settled(found.where("depth = 6"), 6, rules).collect()} == {1}
    assert {r.node for r in jaccard._settled(found, 5, rules).collect()} == {1, 2, 4} - ({2} if 3 * missed(0.82)[1] > 1e-5 * 3 else set())


def test_keep_one(spark):
    rows = [r for r in near_rows() if r[0] is not None]
    docs = frame(spark, rows)
    kept = jaccard.keep_one(docs)
    expected = sorted(i for i, c, _ in brute_links(rows) if c is None or c == i)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == expected
    assert jaccard.classes(empty(spark)).count() == 0 and jaccard.keep_one(empty(spark)).count() == 0


def test_keep_one_with_null_and_shared_ids(spark):
    copy, other = "one two three four five six seven", "quite another text that has its own words"
    chain = "red orange yellow green blue indigo violet"
    rows = [(i, t, "en", "s", 1) for i, t in [(None, copy), (None, copy), (3, copy), (4, copy), (5, chain), (6, chain), (6, other), (None, None), (None, "")]]
    rows += [(None, "alone without id but with words", "en", "s", 1)]
    kept = sorted(str((r.doc_id, r.text)) for r in jaccard.keep_one(frame(spark, rows)).collect())
    expected = [(None, copy), (5, chain), (6, other), (None, None), (None, ""), (None, "alone without id but with words")]
    assert kept == sorted(map(str, expected))


def test_prefix_is_shortened_to_the_target_recall():
    rules = jaccard.Forest()
    d = jaccard.prefix_length(rules)
    assert jaccard.recall_at(rules, d) >= rules.recall > jaccard.recall_at(rules, d + 1)


# -- 10 -----------------------------------------------------------------------------------------


def brute_repeats(rows, length):
    least = {}
    tokens = [(r[0] if r[0] is not None else 1 << 63, words(r[1])) for r in rows]
    for i, w in tokens:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            least[key] = min(least.get(key, i), i)
    out = []
    for (i, w), r in zip(tokens, rows):
        gone = set()
        for k in range(len(w) - length + 1):
            if least[tuple(w[k : k + length])] < i:
                gone |= set(range(k, k + length))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((r[0], len(w), len(gone), kept))
    return out


@pytest.mark.parametrize("rules", [substrings.Repeats(), substrings.Repeats(length=20, gram=4, block=3)])
def test_repeats(spark, rules):
    rows = near_rows()
    expected = [(i, n, g, hashlib.sha256(" ".join(k).encode()).hexdigest()) for i, n, g, k in brute_repeats(rows, rules.length)]
    got = substrings.digests(frame(spark, rows), rules)
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(map(str, expected))


def crowded_rows():
    """Many rows without an id, ids with several texts, a passage in hundreds of texts, and a text of one word."""
    import random

    from tests.llm.helpers import sentence

    rng = random.Random(12)
    licence = sentence(rng, 64)
    rows = []
    for i in range(300):
        text = f"{sentence(rng, rng.randint(1, 40))} {licence} {sentence(rng, rng.randint(1, 40))}"
        rows.append(([None, 5, i + 10][i % 3], text, "en", "s", 1))
    rows += [(None, rows[0][1], "en", "s", 1), (5, rows[1][1], "en", "s", 1), (7, "same " * 4000, "en", "s", 1), (8, "same " * 3000 + "end", "en", "s", 1)]
    own = sentence(rng, 200)
    return rows + [(None, own, "en", "s", 1), (None, own + " more", "en", "s", 1), (6, own[40:], "en", "s", 1)]


@pytest.mark.parametrize("rules", [substrings.Repeats(), substrings.Repeats(block=1000, run=7, shard_segments=10, task_segments=50)])
def test_repeats_in_crowds(spark, rules):
    rows = crowded_rows()
    expected = [(i, n, g, hashlib.sha256(" ".join(k).encode()).hexdigest()) for i, n, g, k in brute_repeats(rows, rules.length)]
    assert sum(g for _, _, g, _ in expected) > 10_000
    got = substrings.digests(frame(spark, rows), rules)
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(map(str, expected))


def test_remove_repeats(spark):
    rows = near_rows()
    docs = frame(spark, rows)
    got = substrings.remove_repeats(docs)
    assert got.columns == docs.columns
    expected = [(i, k) for i, n, g, k in brute_repeats(rows, 50) if not g or g < n]
    assert sorted(str((r.doc_id, words(r.text))) for r in got.collect()) == sorted(map(str, expected))
    whole = {(r[0], r[1]) for r, (_, _, g, _) in zip(rows, brute_repeats(rows, 50)) if not g}
    assert whole <= {(r.doc_id, r.text) for r in got.collect()}
    assert substrings.digests(empty(spark)).count() == 0 and substrings.remove_repeats(empty(spark)).count() == 0


def test_suffix_automaton():
    import random

    rng = random.Random(2)
    for _ in range(50):
        added = [[rng.randrange(3) for _ in range(rng.randrange(12))] for _ in range(3)]
        query = [rng.randrange(3) for _ in range(15)]
        a = substrings.SuffixAutomaton()
        for x in added:
            a.add(x)
        inside = {tuple(x[i:j]) for x in added for i in range(len(x)) for j in range(i, len(x) + 1)}
        brute = [max((n for n in range(k + 2) if tuple(query[k + 1 - n : k + 1]) in inside), default=0) for k in range(len(query))]
        assert a.matched(query) == brute
