"""Operator 5: toxicity by a weighted finite-state pattern grammar.

Words are mapped to symbols: insults, threats, targets (whom a clause is about), negations, words of
reported speech, and others. Five small weighted transducers read the symbols of a clause, one for each
of these matters; composed, they are one deterministic machine whose output weight says how much of a
matched word counts: an insult behind a target counts more, behind a negation or in reported speech
less, and a threat counts only with a target. What a threat in front of its target weighs is held, with
the negation and reported speech around it, until the target comes, and is lost without one. A
document's score is the noisy-or over its clauses.

Insult patterns (whole words and word beginnings) with their weights are learned from a bounded sample
of labelled documents, at most ``sample`` rows of each label, on top of the small seed lists below. The sample
is drawn by hash, so reruns agree. A pattern needs ``least_rows`` toxic texts, however many others there are, so
patterns of small languages count; words of the other classes stay what they are. What a target, a negation, reported
speech and a threat make of a match is learned too: the factors of highest likelihood on the sample, each pulled to
its start by a prior, so that a factor without evidence stays what it is. A pattern's weight follows the lower bound of its precision. One that is certain is
enough for a text; weaker ones are small pieces of evidence, of which a text needs several different ones. How
small follows from the sample too: the largest factor of ``weak`` with which no more than ``most_wrong`` of its
clean texts are marked (long texts meet many weak patterns by chance). No list of patterns is cut. All texts are scored in full.

Defined results:
* null and empty texts, and texts without a matched clause, score 0;
* a document with several labels counts as toxic if any of them is; unlabelled ones teach nothing;
* without any labels, only the seed lists count;
* rows with equal texts get equal scores; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import text as tx
from eventlake.llm.common import crc_remainder, cut, small, table

#: Bytes of text that are looked at together: a worker holds some hundred bytes for each.
SLICE_BYTES = 1 << 19

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORTED = range(6)
SYMBOLS = range(6)

# Fixed seed words by symbol, in English, German, French and Spanish.
SEEDS = {
    INSULT: "idiot moron imbecile scumbag bastard asshole arschloch dummkopf vollidiot connard salaud abruti gilipollas cabrón imbécil",
    THREAT: "kill hurt destroy murder töten umbringen vernichten tuer détruire frapper matar destruir golpear",
    TARGET: "you your he she they him her them du dich ihr euch er sie tu toi vous il elle ils tú usted ustedes él ella ellos",
    NEGATION: "not never no n't nicht nie kein keine ne pas jamais nunca jamás tampoco",
    REPORTED: "said says wrote called claimed sagte sagt schrieb nannte dit disait écrit appelé dijo dice escribió llamó",
}
SEED_INSULT = 0.6


@dataclass(frozen=True)
class Grammar:
    threshold: float = 0.3
    #: Factors of the transducers.
    targeted: float = 1.2
    negated: float = 0.3
    reported: float = 0.5
    threat: float = 0.6
    #: Words that a negation reaches.
    reach: int = 3
    #: Learning: labelled rows of each label, beginnings in bytes, least toxic texts with a pattern.
    sample: int = 6000
    beginnings: tuple[int, ...] = (4, 5, 6, 7, 8, 9, 10, 11, 12)
    least_rows: int = 4
    #: Lower bounds of precision (of so many standard errors) that a pattern needs, and that make it certain.
    least_precision: float = 0.3
    certain: float = 0.9
    errors: float = 1.96
    #: Factors of patterns that aren't certain, to choose from, and the share of clean texts marked at most.
    weak: tuple[float, ...] = (0.3, 0.2, 0.1, 0.05)
    most_wrong: float = 0.004
    #: Deviation of the prior on the logarithm of a factor, and the range and steps (of a factor of 2) that are tried.
    prior: float = 0.7
    tried: tuple[int, int, int] = (-5, 2, 4)


# -- transducers --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Move:
    """What a transducer does on a symbol: its next state, the factor of the symbol's weight, whether the weight
    is held back, and whether held weights count from here on."""

    to: int
    factor: float = 1.0
    hold: bool = False
    release: bool = False


@dataclass
class Transducer:
    """A deterministic weighted transducer: (state, symbol) -> move. State 0 starts a clause."""

    states: int
    moves: dict[tuple[int, int], Move] = field(default_factory=dict)

    def step(self, state: int, symbol: int) -> Move:
        return self.moves.get((state, symbol), Move(state))


@dataclass
class Machine:
    """Composed transducers as tables [state, symbol]."""

    go: np.ndarray
    factor: np.ndarray
    hold: np.ndarray
    release: np.ndarray

    def miss(self, symbols: list[int], weights: list[float]) -> float:
        """The chance that a clause is clean: matched words are independent witnesses."""
        state, miss, held = 0, 1.0, 1.0
        for symbol, weight in zip(symbols, weights):
            if symbol == INSULT or symbol == THREAT:
                clean = 1.0 - min(1.0, weight * self.factor[state, symbol])
                if self.hold[state, symbol]:
                    held *= clean
                else:
                    miss *= clean
            if self.release[state, symbol]:
                miss, held = miss * held, 1.0
            state = self.go[state, symbol]
        return miss


def compose(parts: list[Transducer]) -> Machine:
    """All parts at once: products of factors; one part is enough to hold or to release."""
    places = list(product(*(range(p.states) for p in parts)))
    number = {place: i for i, place in enumerate(places)}
    shape = (len(places), len(SYMBOLS))
    made = Machine(np.zeros(shape, np.int32), np.ones(shape), np.zeros(shape, bool), np.zeros(shape, bool))
    for place, i in number.items():
        for symbol in SYMBOLS:
            moves = [p.step(s, symbol) for p, s in zip(parts, place)]
            made.go[i, symbol] = number[tuple(m.to for m in moves)]
            made.factor[i, symbol] = np.prod([m.factor for m in moves])
            made.hold[i, symbol] = any(m.hold for m in moves)
            made.release[i, symbol] = any(m.release for m in moves)
    return made


def transducers(rules: Grammar) -> list[Transducer]:
    """Insult, threat, target, negation and reported speech."""
    insult = Transducer(1, {(0, INSULT): Move(0)})
    # A threat needs a target in its clause, before or behind it.
    threat = Transducer(2, {(0, THREAT): Move(0, rules.threat, hold=True), (1, THREAT): Move(1, rules.threat)})
    threat.moves |= {(s, TARGET): Move(1, release=True) for s in (0, 1)}
    target = Transducer(2, {(s, TARGET): Move(1) for s in (0, 1)} | {(1, INSULT): Move(1, rules.targeted)})
    negation = Transducer(rules.reach + 1)
    for s in range(rules.reach + 1):
        for symbol in SYMBOLS:
            matched = symbol in (INSULT, THREAT)
            negation.moves[s, symbol] = Move(max(0, s - 1), rules.negated if matched and s else 1.0)
        negation.moves[s, NEGATION] = Move(rules.reach)
    reported = Transducer(2, {(s, REPORTED): Move(1) for s in (0, 1)} | {(1, m): Move(1, rules.reported) for m in (INSULT, THREAT)})
    return [insult, threat, target, negation, reported]


def machine(rules: Grammar) -> Machine:
    return compose(transducers(rules))


FACTORS = ("targeted", "negated", "reported", "threat")


def exponents(rules: Grammar) -> np.ndarray:
    """[state, symbol, factor]: which factors are in the machine's factor there. States are numbered as in ``machine(rules)``."""
    plain = {name: 1.0 for name in FACTORS}
    return np.stack([machine(replace(rules, **(plain | {name: 2.0}))).factor == 2.0 for name in FACTORS], axis=-1)


def witnesses(symbols: list[int], weights: list[float], made: Machine, marks: np.ndarray) -> list[tuple[float, tuple[bool, ...]]]:
    """(weight, which factors it gets) of the matches of a clause that count, by the machine's holds and releases."""
    state, found, held = 0, [], []
    for symbol, weight in zip(symbols, weights):
        if symbol == INSULT or symbol == THREAT:
            (held if made.hold[state, symbol] else found).append((weight, tuple(marks[state, symbol])))
        if made.release[state, symbol]:
            found, held = found + held, []
        state = made.go[state, symbol]
    return found


# -- symbols of words ---------------------------------------------------------------------------

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x30, 0x3A), *range(0x61, 0x7B), 0x27, *range(0x80, 0x100)]] = True
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n")] = True


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[tx.Words, tx.Spans]:
    low = tx.lower_bytes(data)
    return tx.split_words(low, offsets, ~_LETTER), tx.Spans.of(low)


def _word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(tx.Spans.of(data).hash(np.array([0]), np.array([len(data)]))[0])


def pattern_hashes(words: tx.Words, spans: tx.Spans, rules: Grammar) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, word indices, hashes): kind 0 for whole words, else the length of a beginning."""
    yield 0, np.arange(len(words.start)), spans.hash(words.start, words.end)
    size = words.end - words.start
    for n in rules.beginnings:
        long = np.flatnonzero(size > n)
        yield n, long, spans.hash(words.start[long], words.start[long] + n)


@dataclass
class Lexicon:
    """Learned patterns by kind, sorted by hash, with the probability that a match is toxic."""

    learned: dict[int, tuple[np.ndarray, np.ndarray]]
    symbols: tuple[np.ndarray, np.ndarray]
    factors: dict[str, float] = field(default_factory=dict)

    def tuned(self, rules: Grammar) -> Grammar:
        """The rules with the factors that were learned."""
        return replace(rules, **self.factors)

    @classmethod
    def of(cls, rows: list[tuple[int, int, float]]) -> Lexicon:
        learned = {}
        for kind in {r[0] for r in rows}:
            part = sorted((np.int64(h).view(np.uint64), p) for k, h, p in rows if k == kind)
            learned[kind] = (np.array([h for h, _ in part], np.uint64), np.array([p for _, p in part]))
        seeds = sorted((np.uint64(_word_hash(w)), s) for s, words in SEEDS.items() for w in words.split())
        return cls(learned, (np.array([h for h, _ in seeds], np.uint64), np.array([s for _, s in seeds])))

    def read(self, words: tx.Words, spans: tx.Spans, rules: Grammar) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, weight) of each word."""
        n = len(words.start)
        symbol, weight = np.zeros(n, np.int8), np.zeros(n)
        for kind, index, hashes in pattern_hashes(words, spans, rules):
            if kind == 0:
                hit, at = _find(self.symbols[0], hashes)
                symbol[hit] = self.symbols[1][at]
                weight[symbol == INSULT] = SEED_INSULT
                weight[symbol == THREAT] = 1.0
            if kind in self.learned:
                keys, chance = self.learned[kind]
                hit, at = _find(keys, hashes)
                # Threats, targets, negations and words of speech stay what they are.
                fits = (symbol[index[hit]] == OTHER) | (symbol[index[hit]] == INSULT)
                hit, at = hit[fits], at[fits]
                np.maximum.at(weight, index[hit], chance[at])
                symbol[index[hit]] = INSULT
        # A word of weak evidence is one piece of it in its text, however often it stands there.
        weak = np.flatnonzero((symbol == INSULT) & (weight < rules.threshold))
        same = spans.hash(words.start[weak], words.end[weak]) + words.owner()[weak].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        again = np.ones(len(weak), bool)
        again[np.unique(same, return_index=True)[1]] = False
        symbol[weak[again]], weight[weak[again]] = OTHER, 0.0
        return symbol, weight


def _find(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of values that are keys, and their places among the keys."""
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    hit = np.flatnonzero(keys[at] == values)
    return hit, at[hit]


# -- learning -----------------------------------------------------------------------------------


def learn(docs: DataFrame, labels: DataFrame, rules: Grammar = Grammar()) -> Lexicon:
    """Patterns that mark toxic documents, from a bounded sample of labelled rows."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(crc_remainder(F.col("doc_id"), 4) != 2)
    known = cut(known)
    least = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rules.sample) for y in (0, 1)]
    sample = cut(least[0].unionByName(least[1]))
    everywhere = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    # Copies of a text are one witness.
    texts = docs.select("doc_id", "text").join(small(sample, sample.count()), "doc_id").where("text IS NOT NULL")
    texts = texts.groupBy(F.md5(F.col("text").cast("binary")).alias("k")).agg(F.max("toxic").alias("toxic"), F.max("text").alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                words, spans = _words(data, offsets)
                owner = words.owner()
                for kind, index, hashes in pattern_hashes(words, spans, rules):
                    of, bad = owner[index], toxic[lo:hi][owner[index]] == 1
                    _, once = np.unique(tx.mix64(hashes + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
                    found, inverse = np.unique(hashes[once], return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(found), kind, np.int32)),
                            pa.array(tx.signed(found)),
                            pa.array(np.bincount(inverse, bad[once], len(found)).astype(np.int64)),
                            pa.array(np.bincount(inverse, ~bad[once], len(found)).astype(np.int64)),
                        ],
                        ["kind", "hash", "toxic", "clean"],
                    )

    texts = cut(texts)
    rows = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if not rows.get(1):
        return Lexicon.of([])
    counts = texts.mapInArrow(features, "kind int, hash long, toxic long, clean long").groupBy("kind", "hash").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    # Rows of the sample stand for all labelled rows of their label.
    weigh = {y: everywhere.get(y, 0) / max(1, rows.get(y, 0)) for y in (0, 1)}
    # The lower bound (Wilson's) of a pattern's toxic share in the sample, then the share it means for all labelled rows.
    n, z2 = F.col("toxic") + F.col("clean"), rules.errors**2
    share = F.col("toxic") / n
    low = (share + z2 / (2 * n) - rules.errors * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    precise = (low * weigh[1] / (low * weigh[1] + (1 - low) * weigh[0])) if rows.get(0) else low
    found = counts.where(F.col("toxic") >= rules.least_rows).select("kind", "hash", precise.alias("low")).where(F.col("low") >= rules.least_precision)
    patterns = [(r["kind"], r["hash"], r["low"]) for r in found.collect()]
    factors = fit_factors(_evidence(texts, _with_weak(patterns, 0.0, rules), rules), rules)
    clean = texts.where("toxic = 0").select("text")
    for factor in rules.weak:
        lexicon = _with_weak(patterns, factor, rules, factors)
        if _marked(clean, lexicon, rules) <= rules.most_wrong * rows.get(0, 0):
            return lexicon
    return _with_weak(patterns, 0.0, rules, factors)


def _with_weak(patterns: list[tuple[int, int, float]], factor: float, rules: Grammar, factors: dict[str, float] | None = None) -> Lexicon:
    made = Lexicon.of([(k, h, low if low >= rules.certain else low * factor) for k, h, low in patterns if low >= rules.certain or factor])
    made.factors = factors or {}
    return made


#: Weights are rounded to so many parts, so that a text is a bounded number of rows of evidence.
WEIGHT_PARTS = 64
EVIDENCE = "toxic int, text long, code int, weight int, n long"


def _evidence(texts: DataFrame, lexicon: Lexicon, rules: Grammar) -> pd.DataFrame:  # noqa: F821
    """Matches of the sample's texts (text, toxic): how many of each weight and set of factors; texts without matches are left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, marks = machine(rules), exponents(rules)
        names = [f.split()[0] for f in EVIDENCE.split(", ")]
        for batch in batches:
            keys, toxic = batch.column("key").to_pylist(), batch.column("toxic").to_pylist()
            for lo, _, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                counts: dict[tuple, int] = {}
                for text, symbols, weights in _clauses(data, offsets, lexicon, rules):
                    for weight, bits in witnesses(symbols, weights, made, marks):
                        code = sum(bit << k for k, bit in enumerate(bits))
                        row = (toxic[lo + text], keys[lo + text], code, round(weight * WEIGHT_PARTS))
                        counts[row] = counts.get(row, 0) + 1
                columns = list(zip(*[(*row, n) for row, n in counts.items()])) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))], names)

    keyed = texts.select(F.xxhash64("k").alias("key"), F.col("toxic").cast("int").alias("toxic"), "text")
    return keyed.mapInArrow(work, EVIDENCE).toPandas()


def fit_factors(evidence: pd.DataFrame, rules: Grammar) -> dict[str, float]:  # noqa: F821
    """The factors of highest posterior, one after the other until none moves: a text is clean if none of its matches is a witness.

    Texts that no factor touches say nothing about them.
    """
    import pandas as pd  # on the driver only: workers that score need none of it

    start = {name: getattr(rules, name) for name in FACTORS}
    coded = evidence[evidence["text"].isin(evidence.loc[evidence["code"] > 0, "text"])]
    if not len(coded):
        return start
    doc, _ = pd.factorize(coded["text"])
    toxic = np.zeros(doc.max() + 1, bool)
    toxic[doc] = coded["toxic"].to_numpy() == 1
    weight, n = coded["weight"].to_numpy() / WEIGHT_PARTS, coded["n"].to_numpy()
    bits = (coded["code"].to_numpy()[:, None] >> np.arange(len(FACTORS))) & 1

    def posterior(factors: dict[str, float]) -> float:
        logs = np.log([factors[name] for name in FACTORS])
        clean = np.log(1 - np.minimum(weight * np.exp(bits @ logs), 0.999))
        miss = np.bincount(doc, n * clean, len(toxic))
        likelihood = np.where(toxic, np.log(-np.expm1(np.minimum(miss, -1e-6))), miss).sum()
        away = [np.log(factors[name] / start[name]) for name in FACTORS]
        return likelihood - np.square(away).sum() / (2 * rules.prior**2)

    low, high, steps = rules.tried
    best, moved = dict(start), True
    while moved:
        before = dict(best)
        for name in FACTORS:
            tried = [best | {name: start[name] * 2 ** (k / steps)} for k in range(low * steps, high * steps + 1)]
            best = max([best, *tried], key=posterior)
        moved = best != before
    return best


def _marked(texts: DataFrame, lexicon: Lexicon, rules: Grammar) -> int:
    """Texts that score the threshold or more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = machine(lexicon.tuned(rules))
        for batch in batches:
            for _, _, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                score, _ = score_texts(data, offsets, lexicon, made, rules)
                yield pa.RecordBatch.from_arrays([pa.array([int((score >= rules.threshold).sum())], pa.int64())], ["marked"])

    return texts.mapInArrow(work, "marked long").agg(F.sum("marked")).first()[0] or 0


# -- scoring ------------------------------------------------------------------------------------


def _clauses(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon, rules: Grammar) -> Iterator[tuple[int, list[int], list[float]]]:
    """(text, symbols, weights) of the clauses with a matched word."""
    words, spans = _words(data, offsets)
    if not len(words.start):
        return
    symbol, weight = lexicon.read(words, spans, rules)
    breaks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_BREAK[data], out=breaks[1:])
    owner = words.owner()
    clause = breaks[words.start] + owner  # rises at breaks and between texts
    change = np.ones(len(clause), bool)
    change[1:] = (clause[1:] != clause[:-1]) | (owner[1:] != owner[:-1])
    starts = np.append(np.flatnonzero(change), len(clause))
    number = np.cumsum(change) - 1
    for c in np.unique(number[(symbol == INSULT) | (symbol == THREAT)]):
        at = slice(starts[c], starts[c + 1])
        yield int(owner[starts[c]]), symbol[at].tolist(), weight[at].tolist()


def score_texts(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon, made: Machine, rules: Grammar) -> tuple[np.ndarray, np.ndarray]:
    """(score, matched clauses) of each text."""
    n = len(offsets) - 1
    clean, clauses = np.ones(n), np.zeros(n, np.int64)
    for text, symbols, weights in _clauses(data, offsets, lexicon, rules):
        miss = made.miss(symbols, weights)
        if miss < 1.0:
            clean[text] *= miss
            clauses[text] += 1
    return 1.0 - clean, clauses


SCHEMA = "doc_id long, held_out boolean, score double, predicted int, clauses long"


def scores(docs: DataFrame, lexicon: Lexicon, rules: Grammar = Grammar()) -> DataFrame:
    """One row per document: held_out, score, predicted and the number of matched clauses."""
    known = docs.sparkSession.sparkContext.broadcast(lexicon)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = machine(known.value.tuned(rules))
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                score, clauses = score_texts(data, offsets, known.value, made, rules)
                part = batch.slice(lo, hi - lo)
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(score)]
                columns += [pa.array((score >= rules.threshold).astype(np.int32)), pa.array(clauses)]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (crc_remainder(F.col("doc_id"), 4) == 2).alias("held_out"))
    return base.mapInArrow(work, SCHEMA)


def keep_civil(docs: DataFrame, lexicon: Lexicon, rules: Grammar = Grammar()) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, judged row by row."""
    known = docs.sparkSession.sparkContext.broadcast(lexicon)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = machine(known.value.tuned(rules))
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                score, _ = score_texts(data, offsets, known.value, made, rules)
                yield batch.slice(lo, hi - lo).filter(pa.array(score < rules.threshold))

    return docs.mapInArrow(work, docs.schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scores(docs, learn(docs, table(spark, sf_dir, "labels")))
