import hashlib
import random
import re
from collections import defaultdict

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from eventlake.llm import jaccard, mixing, pieces, substrings, toxicity
from tests.llm.helpers import WORD, sentence, words
from tests.llm.test_models import plain_clause
from tests.llm.test_tables import brute_links, targets

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF).write.parquet(str(tmp_path / str(i)))
        seen.append(spark.read.parquet(str(tmp_path / str(i))))
    assert all(s.columns == columns for s in seen[:-1])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bad = toxicity.scores(seen[0], toxicity.learn(seen[0], labels)).where("predicted = 1").select("doc_id")
    assert seen[1].count() == seen[0].count() - bad.count()
    assert jaccard.classes(seen[2]).where("n_links > 0").count() == 0
    assert seen[2].join(seen[1], "doc_id", "left_anti").count() == 0
    assert substrings.digests(seen[3]).agg(F.sum("n_removed")).first()[0] == 0
    copies = mixing.mix(seen[3]).agg(F.sum("copies")).first()[0]
    assert seen[4].count() == copies == seen[5].count()
    back = pieces.decode(seen[5], pieces.Vocabulary.load().prepare())
    assert back.select("doc_id", "text").exceptAll(seen[4].select("doc_id", "text")).count() == 0


def test_empty(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def planted_rows():
    """(doc_id, text, lang, source, n_chars): toxic, copied, near-copied and repeating texts, odd ids, nulls and empty texts."""
    rng = random.Random(21)
    base = [sentence(rng, rng.randint(60, 160)) for _ in range(24)]
    passage = sentence(rng, 75)
    texts = [(i, t) for i, t in enumerate(base)]
    texts += [(100 + i, t) for i, t in enumerate(base[:6])] + [(120 + i, t + " tail end") for i, t in enumerate(base[6:12])]
    texts += [(140, f"{sentence(rng, 40)} {passage} {sentence(rng, 30)}"), (141, f"{passage}\n\n{sentence(rng, 60)}"), (142, passage)]
    texts += [(150, "you are an idiot. " + base[3]), (151, f"{base[4]} they will kill you"), (152, f"{sentence(rng, 30)} kill the process"), (153, "you are not an idiot, " + sentence(rng, 30))]
    texts += [(160, sentence(rng, 50)), (160, sentence(rng, 50)), (None, sentence(rng, 70)), (None, base[13]), (3, base[3]), (170, None), (171, ""), (172, " \n "), (173, "one"), (174, "x" * 3000)]
    return [(i, t, ["en", None][k % 2], ["a", "b", None, ""][k % 4], len(t) if t is not None else None) for k, (i, t) in enumerate(texts)]


def plain_toxicity(text, rules):
    symbol = {w: s for s, ws in toxicity.SEEDS.items() for w in ws.split()}
    clean = 1.0
    for clause in re.split(r"[.,;:!?\n]", (text or "").lower()):
        found = [symbol.get(w, toxicity.OTHER) for w in re.findall(r"[0-9a-z'\u0080-\U0010ffff]+", clause)]
        weights = [toxicity.SEED_INSULT if s == toxicity.INSULT else 1.0 for s in found]
        clean *= plain_clause(found, weights, rules)
    return 1 - clean


def plain_pipeline(rows):
    rules = toxicity.Grammar()
    rows = [r for r in rows if plain_toxicity(r[1], rules) < rules.threshold]
    kept, seen = [], set()
    for r, (i, least, _) in zip(rows, brute_links(rows)):
        key = tuple(sorted({tuple(words(r[1])[k : k + 5]) for k in range(max(1, len(words(r[1])) - 4))}))
        if not words(r[1]):
            kept.append(r)
        elif i == least and (i, key) not in seen:
            kept.append(r)
            seen.add((i, key))
    rows, out = kept, []
    least = {}
    ids = [r[0] if r[0] is not None else 1 << 63 for r in rows]
    for i, r in zip(ids, rows):
        for k in range(len(words(r[1])) - 49):
            key = tuple(words(r[1])[k : k + 50])
            least[key] = min(least.get(key, i), i)
    for i, r in zip(ids, rows):
        w = words(r[1])
        gone = {p for k in range(len(w) - 49) if least[tuple(w[k : k + 50])] < i for p in range(k, k + 50)}
        if gone:
            spans = [m.start() for m in WORD.finditer(r[1])] + [len(r[1])]
            text = r[1][: spans[0]] + "".join(r[1][a:b] for k, (a, b) in enumerate(zip(spans, spans[1:])) if k not in gone)
            r = (r[0], text, *r[2:])
        if not gone or len(gone) < len(w):
            out.append((*r[:4], len(r[1]) if r[1] is not None else None))
    rows = out
    size = lambda r: len(words(r[1]))
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    h = lambda r: md5((str(r[0]) if r[0] is not None else "") + " " + md5(r[1] or ""))[:15]
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r)
    goal = targets({s: sum(map(size, some)) for s, some in by_source.items()})
    mixed = []
    for source, some in by_source.items():
        total = sum(map(size, some))
        copies = min(3, int(goal[source] // total)) if total else 0
        budget, upto = goal[source] - copies * total, 0
        for key in sorted({h(r) for r in some if size(r)}):
            group = [r for r in some if h(r) == key and size(r)]
            edge = sum(map(size, group))
            upto += edge
            extra = upto < budget or ((upto - edge < budget or upto == edge) and (budget - (upto - edge)) * 2 >= edge)
            mixed += group * min(3, copies + extra)
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    return [(r[0], r[2], r[3], r[4], tuple(model.encode(r[1]))) for r in mixed]


def test_run_on_planted_documents(spark, tmp_path):
    """All rows of run() against plain versions of the five stages."""
    rows = planted_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    found = sorted(str((r.doc_id, r.lang, r.source, r.n_chars, tuple(r.token_ids))) for r in got)
    assert found == sorted(map(str, plain_pipeline(rows)))
    assert {150, 151} & {r.doc_id for r in got} == set() and all(r.n_tokens == len(r.token_ids) for r in got)


def test_stages_of_odd_rows_and_clashing_columns(spark):
    from tests.llm.helpers import empty, odd

    labels_dir = SF
    for rows in (odd(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, labels_dir)
            assert out.columns == rows.columns and out.count() <= 3 * rows.count()
