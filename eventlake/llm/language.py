"""Operator 9: language identification with a bidirectional gated recurrent network over bytes.

Two small GRUs read the UTF-8 bytes of a text, one forwards, one backwards. At every byte position
both states give probabilities of the languages; a document's probabilities are their mean over all
its positions. The network is trained in numpy by backpropagation through time on a bounded sample of
labelled rows (``sample`` of each language, ``most_rows`` in all, drawn by hash), with a fixed seed;
of a long one, it reads ``windows`` windows of ``window`` characters.

Whole texts are labelled: texts are cut into sequences of ``span`` bytes, each of which also reads ``margin``
bytes on both sides without labelling them, so that states don't begin at a cut. Sequences of many texts
advance together one byte at a time, and shorter last sequences are grouped by length so that little
padding is computed. Memory is bounded by ``rows`` sequences at a time. Each document is independent,
so scoring is one scan without a shuffle.

Defined results:
* a null text, or one without a letter, is ``und`` with score 0; so is everything if nothing is labelled;
* rows with equal texts get equal results, whatever their batch, up to rounding of the score;
* ties between languages go to the first by code point; an empty table gives an empty result; extra
  columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm import text as tx
from eventlake.llm.common import crc_remainder, table

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    hidden: int = 8
    span: int = 512
    margin: int = 16
    #: Sequences that advance together.
    rows: int = 2048
    #: Training: documents of each language, windows of each document, bytes of a window, and steps.
    sample: int = 150
    most_rows: int = 20_000
    windows: int = 4
    window: int = 64
    batch: int = 96
    steps: int = 300
    rate: float = 0.02
    seed: int = 11


# -- network ------------------------------------------------------------------------------------
#
# Arrays are features x sequences. Gates are stacked as update, reset, candidate.


@dataclass
class Direction:
    """One GRU: input rows of each byte (3h x 256), recurrent weights (3h x h), output weights (c x h)."""

    table: np.ndarray
    recur: np.ndarray
    out: np.ndarray


@dataclass
class Network:
    directions: tuple[Direction, Direction]
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [a for d in self.directions for a in (d.table, d.recur, d.out)] + [self.bias]


def start(classes: int, s: Settings) -> Network:
    rng = np.random.default_rng(s.seed)
    h = s.hidden

    def direction() -> Direction:
        scale = 1 / np.sqrt(h)
        return Direction(rng.normal(0, 0.3, (3 * h, 256)), rng.normal(0, scale, (3 * h, h)), rng.normal(0, scale, (classes, h)))

    return Network((direction(), direction()), np.zeros((classes, 1)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=-2, keepdims=True))
    return p / p.sum(axis=-2, keepdims=True)


def _forward(d: Direction, data: np.ndarray) -> tuple[list, np.ndarray]:
    """What backpropagation needs of each step, and the states (steps x h x sequences)."""
    steps, n = data.shape
    h = d.recur.shape[1]
    state = np.zeros((h, n))
    kept, states = [], np.empty((steps, h, n))
    for t in range(steps):
        given, back = d.table[:, data[t]], d.recur @ state
        z, r = _sigmoid(given[:h] + back[:h]), _sigmoid(given[h : 2 * h] + back[h : 2 * h])
        c = np.tanh(given[2 * h :] + r * back[2 * h :])
        kept.append((state, z, r, c, back[2 * h :]))
        state = states[t] = c + z * (state - c)
    return kept, states


def _backward(d: Direction, data: np.ndarray, kept: list, slope: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the table and the recurrent weights; slope: of the loss by each state."""
    steps, n = data.shape
    h = d.recur.shape[1]
    table, recur = np.zeros_like(d.table), np.zeros_like(d.recur)
    carry = np.zeros((h, n))
    given = np.empty((steps, 3 * h, n))
    for t in range(steps - 1, -1, -1):
        state, z, r, c, back = kept[t]
        total = slope[t] + carry
        by_c = total * (1 - z) * (1 - c * c)
        by_z = total * (state - c) * z * (1 - z)
        by_r = by_c * back * r * (1 - r)
        given[t] = np.concatenate([by_z, by_r, by_c])
        inner = np.concatenate([by_z, by_r, by_c * r])
        recur += inner @ state.T
        carry = total * z + d.recur.T @ inner
    flat = given.transpose(1, 0, 2).reshape(3 * h, -1)
    for k in range(3 * h):
        table[k] = np.bincount(data.ravel(), flat[k], 256)
    return table, recur


def gradients(net: Network, data: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions, and its gradients; data is steps x sequences."""
    f, b = net.directions
    kept_f, states_f = _forward(f, data)
    kept_b, states_b = _forward(b, data[::-1])
    p = _softmax(f.out @ states_f + b.out @ states_b[::-1] + net.bias)
    steps, classes, n = p.shape
    loss = -np.log(p[:, labels, np.arange(n)] + 1e-12).mean()
    p[:, labels, np.arange(n)] -= 1
    p /= steps * n
    slopes = (f.out.T @ p, (b.out.T @ p)[::-1])
    out: list[np.ndarray] = []
    for d, kept, states, slope, text in ((f, kept_f, states_f, slopes[0], data), (b, kept_b, states_b[::-1], slopes[1], data[::-1])):
        by_table, by_recur = _backward(d, text, kept, slope)
        out += [by_table, by_recur, np.einsum("tcn,thn->ch", p, states)]
    return loss, [*out, p.sum(axis=(0, 2))[:, None]]


def train(data: np.ndarray, labels: np.ndarray, classes: int, s: Settings) -> Network:
    """Adam over random batches of windows; data is windows x bytes."""
    net = start(classes, s)
    rng = np.random.default_rng(s.seed + 1)
    params = net.parameters()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    by_class = [np.flatnonzero(labels == c) for c in range(classes)]
    for step in range(1, s.steps + 1):
        pick = np.array([rng.choice(by_class[c]) for c in rng.integers(0, classes, s.batch)])
        _, slopes = gradients(net, data[pick].T, labels[pick])
        rate = s.rate * min(1.0, 2.0 * (1 - step / (s.steps + 1)))
        for p, g, m, v in zip(params, slopes, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


# -- scoring ------------------------------------------------------------------------------------


class Labeller:
    """A trained network in single precision; sigmoids are folded into tanh of halved weights."""

    def __init__(self, net: Network, s: Settings) -> None:
        self.s = s
        self.h = net.directions[0].recur.shape[1]
        half = np.ones((3 * self.h, 1))
        half[: 2 * self.h] = 0.5
        self.parts = [tuple(np.ascontiguousarray(a, np.float32) for a in (d.table * half, d.recur * half, d.out)) for d in net.directions]
        self.bias = net.bias.astype(np.float32)

    def _states(self, which: int, data: np.ndarray, alive: np.ndarray | None) -> Iterator[tuple[int, np.ndarray]]:
        table, recur, _ = self.parts[which]
        steps, n = data.shape
        h = self.h
        state = np.zeros((h, n), np.float32)
        for t in range(steps) if which == 0 else range(steps - 1, -1, -1):
            given = np.take(table, data[t], axis=1)
            back = recur @ state
            gates = given[: 2 * h]
            gates += back[: 2 * h]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            c = back[2 * h :]
            c *= gates[h:]
            c += given[2 * h :]
            np.tanh(c, out=c)
            state = state - c
            state *= gates[:h]
            state += c
            if alive is not None and which == 1:
                state *= alive[t]
            yield t, state

    def label(self, data: np.ndarray, alive: np.ndarray | None, counts: np.ndarray | None = None) -> np.ndarray:
        """Sums of position probabilities of each sequence: classes x sequences.

        ``alive`` has the positions that are not padding, ``counts`` those that are summed.
        """
        counts = alive if counts is None else counts
        logits = np.empty((len(data), len(self.bias), data.shape[1]), np.float32)
        for t, state in self._states(0, data, alive):
            np.matmul(self.parts[0][2], state, out=logits[t])
        total = np.zeros(logits.shape[1:], np.float64)
        for t, state in self._states(1, data, alive):
            p = self.parts[1][2] @ state
            p += logits[t]
            p += self.bias
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            total += p if counts is None else p * counts[t]
        return total

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean position probabilities of each text: texts x classes; zeros for empty texts."""
        span, margin, n = self.s.span, self.s.margin, len(offsets) - 1
        size = np.diff(offsets)
        pieces = -(-size // span)
        owner = np.repeat(np.arange(n), pieces)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        own = offsets[owner] + within * span
        own_end = np.minimum(own + span, offsets[owner + 1])
        start = np.maximum(own - margin, offsets[owner])
        length = np.minimum(own_end + margin, offsets[owner + 1]) - start
        total = np.zeros((n, len(self.bias)))
        order = np.argsort(-length, kind="stable")
        padded = np.append(data, np.zeros(span + 2 * margin, np.uint8))
        for at in range(0, len(order), self.s.rows):
            part = order[at : at + self.s.rows]
            steps = int(length[part[0]])
            place = np.arange(steps)[:, None]
            block = padded[start[part][None, :] + place]
            alive = None if length[part[-1]] == steps else (place < length[part][None, :]).astype(np.float32)
            counts = ((place >= (own - start)[part][None, :]) & (place < (own_end - start)[part][None, :])).astype(np.float32)
            np.add.at(total, owner[part], self.label(block, alive, counts).T)
        return total / np.maximum(size, 1)[:, None]


# -- Spark --------------------------------------------------------------------------------------


@dataclass
class Model:
    languages: list[str]
    network: Network | None


def learn(docs: DataFrame, s: Settings = Settings()) -> Model:
    """Train on at most ``sample`` rows of each language that may be learned from, ``most_rows`` in all.

    A row's windows go with its own language, so rows that share an id teach each their own. With more languages than
    ``most_rows``, the first of them by code point are learned. Rows are ranked by their windows alone, not by their texts.
    """
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(crc_remainder(F.col("doc_id"), 4) != 2)
    languages = rows.agg(F.count_distinct("lang")).first()[0]
    each = max(1, min(s.sample, s.most_rows // max(1, languages)))
    # A window of a long text is enough to learn from: windows lie evenly over the text.
    need = s.window * s.windows
    size = F.length("text")
    starts = [F.floor(size * k / s.windows) + 1 for k in range(s.windows)]
    pieces = F.array(*[F.substring("text", a.cast("int"), F.lit(s.window)) for a in starts])
    windows = F.when(size <= need, F.array("text")).otherwise(pieces)
    some = rows.select(F.col("doc_id").cast("long").alias("id"), F.col("lang").cast("string").alias("lang"), windows.alias("w"))
    # Spark limits ranks before the shuffle, so a language with most rows sends few.
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", F.xxhash64("w"), "w")
    ranked = some.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
    found = ranked.orderBy("lang", "place").limit(s.most_rows).select("id", "lang", "w").collect()
    found.sort(key=lambda r: (r["id"], r["lang"], r["w"]))
    languages = sorted({r["lang"] for r in found})
    data, labels = [], []
    for r in found:
        for piece in r["w"]:
            raw = piece.encode()
            for at in range(0, max(1, len(raw) - s.window // 2), s.window):
                part = raw[at : at + s.window]
                if part.strip():
                    data.append(np.frombuffer((part * (s.window // len(part) + 1))[: s.window], np.uint8))
                    labels.append(languages.index(r["lang"]))
    if not data or len(set(labels)) < len(languages):
        languages = sorted({languages[c] for c in labels})
        labels = [sorted(set(labels)).index(c) for c in labels]
    if not data:
        return Model([], None)
    return Model(languages, train(np.stack(data), np.array(labels), len(languages), s))


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def predict(docs: DataFrame, model: Model, s: Settings = Settings()) -> DataFrame:
    """One row per document: held_out, predicted language and its pooled probability."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model.network, s) if model.network else None
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                letters = part.column("letters").to_numpy(zero_copy_only=False)
                best, score = np.full(hi - lo, len(names) - 1), np.zeros(hi - lo)
                if labeller and letters.any():
                    mean = labeller.documents(data, offsets)
                    best[letters] = mean.argmax(axis=1)[letters]
                    score[letters] = np.clip(mean.max(axis=1)[letters], 0, 1)
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(names[best], pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        (crc_remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    return base.mapInArrow(work, SCHEMA)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, learn(docs))
