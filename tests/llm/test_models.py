"""Learned operators, vectors, pieces and archives."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from eventlake.llm import language, neighbours, pieces, toxicity, warc
from tests.llm.helpers import empty, odd

SF = "/root/testdata/sf0.01"


# -- 1 ------------------------------------------------------------------------------------------


def vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(400)]
    rows += [(400 + i, rows[20][1]) for i in range(60)]  # ties
    nan, inf = float("nan"), float("inf")
    rows += [(600, None), (620, [0.0] * 24), (640, [nan] + [1.0] * 23), (660, [inf] * 24), (680, [None] + [1.0] * 23), (None, [1.0] * 24), (700, [])]
    rows += [(720, [1.0, 2.0]), (721, [2.0, 1.0]), (40, rows[40][1])]
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, dim string")


def test_nearest(spark):
    df = vectors(spark)
    encoded = neighbours.encode(df, "vec_id", "embedding")
    rules = neighbours.Blocks(k=20, query_rows=8, candidate_rows=100, tile_queries=3, tile_candidates=37, least_rows=50)
    got = neighbours.nearest(encoded, encoded.where("vec_id % 20 = 0"), rules).collect()
    clean = {}
    for r in df.collect():
        e = r.embedding
        if r.vec_id is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e):
            clean[r.vec_id] = np.array(e)
    expected = []
    for q, e in clean.items():
        if q % 20 == 0:
            near = sorted((-float(sum(a * b for a, b in zip(e, x))), v) for v, x in clean.items() if v != q and len(x) == len(e))[:20]
            expected += [(q, k + 1, v, -s) for k, (s, v) in enumerate(near)]
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(x[:3] for x in expected)
    scores = {x[:3]: x[3] for x in expected}
    assert all(r.score == pytest.approx(scores[r.query_id, r["rank"], r.vec_id], rel=1e-12) for r in got)
    none = encoded.limit(0)
    assert neighbours.nearest(none, none, rules).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(50, 1500))
    codes, scale, error = neighbours.quantise(x)
    about = neighbours.code_products(codes.astype(np.float32), codes.astype(np.float32)) * scale[:, None] * scale[None, :]
    norm = np.linalg.norm(x, axis=1)
    bound = np.linalg.norm(codes * scale[:, None], axis=1)[:, None] * error[None, :] + error[:, None] * norm[None, :]
    assert (np.abs(about - x @ x.T) <= bound + 1e-9).all()


# -- 4 ------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tables():
    return pieces.Vocabulary.load().prepare()


def test_pieces_equal_the_library(tables):
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rng = random.Random(5)
    letters = "abcdefghiéñß the of and ▁ \n\t.,;(){}=<>/\"'0123中文😀\r"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["", " ", "   a", " " * 37 + "b", "x" * 700, "\x00\x01", "▁▁▁", "    def f(x):\r\n        return {}\r\n", "aaaa aaaaa aaaaaaa", " " * 100]
    got = []
    encoder = pieces.Encoder(tables)
    import pyarrow as pa

    for lo, hi, data, offsets in pieces.tx.slices(pa.array(texts), 20000):
        ids, at = encoder.encode(data, offsets)
        raw, ends = pieces.decode_ids(ids.astype(np.int64), at, tables)
        for i in range(hi - lo):
            got.append(ids[at[i] : at[i + 1]].tolist())
            assert raw[ends[i] : ends[i + 1]].tobytes().decode() == texts[lo + i].replace("▁", " ")
    assert got == model.encode(texts)


def test_long_words_equal_the_library(tables):
    """Words of a million characters without a space: random letters, code, one letter, and short patterns."""
    import base64
    import time

    import pyarrow as pa

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rng = np.random.default_rng(3)
    letters = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    texts = [letters(1_000_000), base64.b64encode(rng.bytes(200_000)).decode(), "a" * 100_003, "abcab" * 20_001, "theth" * 3_000 + letters(5_000), "=" * 5_000, "0" * 30_001]
    texts += [letters(int(n)) for n in rng.integers(1000, 2500, 40)]
    encoder = pieces.Encoder(tables)
    for text in texts:
        began = time.perf_counter()
        (_, _, data, offsets), *_ = pieces.tx.slices(pa.array([text]))
        ids, _ = encoder.encode(data, offsets)
        took = time.perf_counter() - began
        assert ids.tolist() == model.encode(text)
        assert took < 30, (text[:20], took)


def test_pieces_on_tables(spark, tables):
    docs = odd(spark)
    coded = pieces.encode(docs, tables)
    assert "text" not in coded.columns and coded.count() == docs.count()
    back = pieces.decode(coded, tables)
    assert sorted(str((r.doc_id, r.text)) for r in back.collect()) == sorted(str((r.doc_id, r.text)) for r in docs.collect())
    assert coded.where("token_ids IS NULL").count() == docs.where("text IS NULL").count()
    assert pieces.decode(pieces.encode(empty(spark), tables), tables).count() == 0


# -- 5 ------------------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    found = toxicity.scores(docs, toxicity.learn(docs, labels)).join(labels, "doc_id").where("held_out")
    english = found.join(docs.where("lang = 'en'"), "doc_id")
    counts = {(r.toxic, r.predicted): r["count"] for r in english.groupBy("toxic", "predicted").count().collect()}
    assert counts.get((1, 1), 0) >= 0.85 * (counts.get((1, 1), 0) + counts.get((1, 0), 0)) and counts.get((0, 1), 0) <= 2


def test_toxicity_held_out_in_all_languages(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.scores(docs, toxicity.learn(docs, labels)).where("held_out").join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    got = {(r.lang, r.toxic, r.predicted): r["count"] for r in found.groupBy("lang", "toxic", "predicted").count().collect()}
    print(got)
    for lang, least in (("en", 0.9), ("de", 0.85), ("fr", 0.9), ("es", 0.5)):
        n = [[got.get((lang, y, p), 0) for p in (0, 1)] for y in (0, 1)]
        assert n[1][1] >= least * sum(n[1]), lang
        assert n[0][1] <= 0.03 * sum(n[0]), lang


def _score(text, lexicon, rules):
    data = np.frombuffer(text.encode(), np.uint8)
    return toxicity.score_texts(data, np.array([0, len(data)]), lexicon, toxicity.machine(rules), rules)[0][0]


def test_toxicity_grammar():
    rules, lexicon = toxicity.Grammar(), toxicity.Lexicon.of([])
    s = lambda t: _score(t, lexicon, rules)
    plain, targeted = s("what an idiot"), s("you are an idiot")
    negated, reported = s("you are not an idiot"), s("she said an idiot came")
    assert targeted > plain >= rules.threshold > negated and plain > reported > 0
    assert s("I will kill you") >= rules.threshold and s("kill the process") == 0 and s("you will kill it") > 0
    assert s("idiot. moron!") > plain and s("a plain text, nothing else") == 0 and s("IDIOT") == plain
    assert s("not here, an idiot") > negated  # negation ends with its clause


def test_threats_keep_what_is_around_them():
    rules, lexicon = toxicity.Grammar(), toxicity.Lexicon.of([])
    s = lambda t: _score(t, lexicon, rules)
    assert s("kill and destroy the process") == 0
    assert s("i will not kill you") == pytest.approx(0.3 * s("i will kill you")) and s("i will kill you") == pytest.approx(0.6)
    assert s("it was said to kill them") == pytest.approx(0.5 * 0.6)
    assert s("kill and destroy them") == pytest.approx(1 - 0.4 * 0.4) and s("kill it. you") == 0
    kill = int(np.uint64(toxicity._word_hash("kill")).astype(np.int64))
    learned = toxicity.Lexicon.of([(0, kill, 0.95)])
    assert _score("kill the process", learned, rules) == 0 and _score("i will kill you", learned, rules) == pytest.approx(0.6)


def plain_clause(symbols, weights, rules):
    """The five parts by their words, without a machine."""
    clean = 1.0
    for i, (s, w) in enumerate(zip(symbols, weights)):
        if s not in (toxicity.INSULT, toxicity.THREAT):
            continue
        before = symbols[:i]
        f = 1.0
        if s == toxicity.INSULT and toxicity.TARGET in before:
            f *= rules.targeted
        if s == toxicity.THREAT:
            f *= rules.threat if toxicity.TARGET in symbols else 0.0
        if toxicity.NEGATION in before[max(0, i - rules.reach) :]:
            f *= rules.negated
        if toxicity.REPORTED in before:
            f *= rules.reported
        clean *= 1 - min(1.0, w * f)
    return clean


def test_composed_machine_against_its_parts():
    from itertools import product

    rules = toxicity.Grammar()
    made = toxicity.machine(rules)
    weights = [0.9, 0.5, 0.7, 0.3, 1.0, 0.6]
    for n in range(7):
        for symbols in product(toxicity.SYMBOLS, repeat=n):
            assert abs(made.miss(symbols, weights) - plain_clause(symbols, weights, rules)) < 1e-12, symbols


def test_toxicity_odd(spark):
    docs = odd(spark)
    labels = spark.createDataFrame([(1, 1, None), (None, 1, 1), (3, 0, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(docs, labels)
    rows = toxicity.scores(docs, lexicon).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.keep_civil(docs, lexicon).columns == docs.columns
    assert toxicity.learn(empty(spark), labels.limit(0)).learned == {}
    assert toxicity.scores(empty(spark), lexicon).count() == 0


# -- 8 ------------------------------------------------------------------------------------------


def page_rows():
    return [
        (5, "http://a/x", "<p>same é</p>", 1), (3, "http://a/y\r\nbad", "<p>same é</p>", 1), (9, None, "<p>same é</p>", 1), (4, "http://b", None, 1),
        (2, "http://b", "", 1), (7, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n", 1), (8, "u", "x" * 300_000, 1), (None, "u", "alone", 1),
        (None, "u", "<p>same é</p>", 1), (11, "u", "rep", 1), (11, "u", "rep", 1), (-6, "u", "negative", 1),
    ]


def test_warc(spark, tmp_path):
    import base64
    import hashlib

    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string, digest int")
    path = str(tmp_path / "w")
    warc.archive(pages, path)
    got = sorted(str(tuple(r)) for r in warc.read_archive(spark, path).collect())
    least = {}
    for i, _, html, _ in page_rows():
        if i is not None:
            least[html or ""] = min(least.get(html or "", i), i)
    expected = []
    for i, _, html, _ in page_rows():
        raw = (html or "").encode()
        origin = least.get(html or "")
        again = origin is not None and i != origin
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        expected.append(str((i, len(raw), digest, "revisit" if again else "response", origin if again else None)))
    assert got == sorted(expected)
    again = spark.read.format("warc").load(path)
    assert again.where("record_type = 'response' AND payload IS NULL").count() == 0
    assert again.where(F.col("record_type").isin("revisit", "request")).count() == sum("revisit" in e for e in expected)
    text = again.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter is" not in text and "Filter (" not in text
    warc.archive(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).count() == 0


def test_warc_files_without_lengths(tmp_path):
    import gzip

    row = dict.fromkeys(warc.HEADERS) | {"record_type": "response", "record_id": "<urn:x>", "payload": b"p" * 9000, "payload_bytes": 9000}
    records = [warc.record_bytes(row | {"target_uri": f"u{i}"}) for i in range(5)]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "c.warc.gz").write_bytes(b"".join(warc.gzip_member(r, 6) for r in records))
    for name in ("a.warc", "b.warc.gz", "c.warc.gz"):
        path = str(tmp_path / name)
        assert [r[2] for r in warc.read_records(path, {}, True)] == [f"u{i}" for i in range(5)]
        one = list(warc.read_records(path, {"target_uri": {"u3"}}, True))
        assert [r[2] for r in one] == ["u3"] and one[0][-1] == b"p" * 9000
        assert [r[-2:] for r in warc.read_records(path, {}, False)] == [(9000, None)] * 5
    assert gzip.decompress((tmp_path / "c.warc.gz").read_bytes()) == b"".join(records)


def test_warc_overwrite_and_leftovers(spark, tmp_path):
    warc.register(spark)
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string, digest int")
    path = str(tmp_path / "w")
    for _ in range(2):
        warc.page_records(pages).write.format("warc").mode("overwrite").save(path)
    assert spark.read.format("warc").load(f"file:{path}").count() == len(page_rows())
    assert all(p.name.endswith(".warc.gz") for p in (tmp_path / "w").iterdir())
    bad = warc.page_records(pages).withColumn("record_type", F.when(F.col("record_id").contains("0003>"), F.raise_error(F.lit("x"))).otherwise(F.col("record_type")))
    with pytest.raises(Exception, match="x"):
        bad.write.format("warc").mode("append").save(path)
    assert all(p.name.endswith(".warc.gz") for p in (tmp_path / "w").iterdir())
    assert spark.read.format("warc").load(path).count() == len(page_rows())
    few = sorted(str(tuple(r)) for r in warc.page_records(pages, broadcast_rows=0).collect())
    assert few == sorted(str(tuple(r)) for r in warc.page_records(pages).collect())


def test_warc_malformed_records(spark, tmp_path):
    import gzip

    warc.register(spark)
    row = dict.fromkeys(warc.HEADERS) | {"record_type": "response", "record_id": "<urn:x>", "payload": b"p" * 9000, "payload_bytes": 9000}
    good = [warc.record_bytes(row | {"target_uri": f"u{i}"}) for i in range(3)]
    odd = [b"no header at all", good[0].replace(b"Content-Length: 90", b"Content-Length: x0"), b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort"]
    member = warc.gzip_member
    files = {
        "lx.warc.gz": (b"".join(member(r, 6) for r in [good[0], *odd, good[1]]), ["u0", "u1"], 3),
        "cut.warc.gz": (member(good[0], 6) + gzip.compress(good[1])[:-30], ["u0"], 1),
        "cut.warc": (good[0] + good[1] + good[2][:-700], ["u0", "u1"], 1),
        "junk.warc": (good[0] + b"junk" * 50 + good[1], ["u0"], 1),
        "bytes.warc.gz": (gzip.compress(good[0]) + b"junk" * 50, ["u0"], 1),
    }
    for name, (data, uris, wrong) in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / name).write_bytes(data)
        load = lambda mode: spark.read.format("warc").option("mode", mode).load(str(tmp_path / name))  # noqa: B023, E731
        assert [r.target_uri for r in load("skip").orderBy("target_uri").collect()] == uris, name
        assert load("mark").where("record_type = 'malformed'").count() == wrong and load("mark").count() == wrong + len(uris), name
        with pytest.raises(Exception, match="record at byte"):
            load("fail").count()


# -- 9 ------------------------------------------------------------------------------------------


def test_gradients():
    s = language.Settings(hidden=3)
    net = language.start(3, s)
    rng = np.random.default_rng(0)
    data, labels = rng.integers(97, 110, (6, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, slopes = language.gradients(net, data, labels)
    for p, g in zip(net.parameters(), slopes):
        for _ in range(5):
            at = tuple(rng.integers(0, k) for k in p.shape)
            old = p[at]
            p[at] = old + 1e-5
            up = language.gradients(net, data, labels)[0]
            p[at] = old - 1e-5
            down = language.gradients(net, data, labels)[0]
            p[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-6


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.predict(docs, language.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()


def test_language_odd(spark):
    s = language.Settings(steps=20)
    docs = odd(spark)
    model = language.learn(docs, s)
    rows = language.predict(docs, model, s).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.lang_pred in (*model.languages, "und")
    assert {r.lang_pred for r in rows if r.doc_id in (0, 1, 2)} == {"und"}
    blank = language.learn(empty(spark), s)
    assert {r.lang_pred for r in language.predict(docs, blank, s).collect()} == {"und"}
    assert language.predict(empty(spark), model, s).count() == 0


def test_long_and_short_texts_agree():
    """Batches and padding don't change a text's probabilities."""
    s = language.Settings(span=32, rows=7)
    lab = language.Labeller(language.start(3, s), s)
    rng = np.random.default_rng(1)
    texts = [rng.integers(32, 127, n).astype(np.uint8) for n in (1, 5, 31, 32, 33, 200, 64, 0, 90)]
    at = np.cumsum([0, *map(len, texts)])
    together = lab.documents(np.concatenate(texts), at)
    for i, t in enumerate(texts):
        alone = lab.documents(t, np.array([0, len(t)]))
        assert np.allclose(alone[0], together[i], atol=1e-5)


def plain_gru(net, text):
    """Mean probabilities over all bytes of a text, one byte and one unit at a time."""
    from math import exp, tanh

    logistic = lambda x: 1 / (1 + exp(-x))

    def states(d, data):
        h = d.recur.shape[1]
        state, out = [0.0] * h, []
        for byte in data:
            back = [sum(d.recur[k, j] * state[j] for j in range(h)) for k in range(3 * h)]
            z = [logistic(d.table[k, byte] + back[k]) for k in range(h)]
            r = [logistic(d.table[h + k, byte] + back[h + k]) for k in range(h)]
            c = [tanh(d.table[2 * h + k, byte] + r[k] * back[2 * h + k]) for k in range(h)]
            state = [z[k] * state[k] + (1 - z[k]) * c[k] for k in range(h)]
            out.append(state)
        return out

    f, b = net.directions
    ahead, behind = states(f, text), states(b, text[::-1])[::-1]
    total = np.zeros(len(net.bias))
    for x, y in zip(ahead, behind):
        logits = f.out @ np.array(x) + b.out @ np.array(y) + net.bias[:, 0]
        p = np.exp(logits - logits.max())
        total += p / p.sum()
    return total / max(1, len(text))


def test_labeller_equals_a_plain_network():
    net = language.start(3, language.Settings(hidden=4))
    rng = np.random.default_rng(7)
    texts = [rng.integers(32, 127, n).astype(np.uint8) for n in (1, 7, 60, 130, 33)]
    at = np.cumsum([0, *map(len, texts)])
    whole = language.Labeller(net, language.Settings(span=1000)).documents(np.concatenate(texts), at)
    cut = language.Labeller(net, language.Settings(span=20, margin=24, rows=5)).documents(np.concatenate(texts), at)
    for i, t in enumerate(texts):
        plain = plain_gru(net, t.tolist())
        _, states = language._forward(net.directions[0], t[:, None])
        assert np.isfinite(states).all()
        assert np.allclose(plain, whole[i], atol=1e-5) and np.allclose(plain, cut[i], atol=2e-2)


def test_languages_share_a_bounded_sample(spark):
    rows = [(i, f"text number {i} of a language with words", f"l{i % 50}", "x") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language.learn(docs, language.Settings(steps=2, most_rows=100))
    assert len(model.languages) == 50
