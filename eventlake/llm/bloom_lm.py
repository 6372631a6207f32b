"""Operator 6: language-model scoring with a log-frequency Bloom filter.

The filter holds, for each bigram and trigram with quantised log-count q, the q keys (n-gram, 1) ... (n-gram, q).
A count is read back by probing levels until one is missing, so a stored n-gram is never read too low, and
too high only with the filter's error rate. Levels are single counts at first and then grow by ``base``, so
a count read back is at most a few percent off.

The model interpolates trigrams, bigrams and words, each order with pseudo-counts of the one below:
``p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1))``, ``p(w|v) = (c(v,w) + m2 p(w)) / (c(v) + m2)`` and
``p(w|u,v) = (c(u,v,w) + m3 p(w|v)) / (c(u,v) + m3)``. A text begins with a start token, which is context only.
With exact counts, each of them sums to 1 over all words, the end and one unknown word; words have their
exact counts here, n-grams those read from the filter.

All bigrams and trigrams of all training texts are stored, those seen once too, whatever the corpus. The
filter is dealt into segments by n-gram hash, whose number follows the corpus and whose bits follow their
keys; no task and no driver holds more than a segment. Texts go into bundles of bounded size; a bundle
sends each segment its distinct n-grams with their training counts (so a common n-gram is one entry of a
bundle; empty entries are not sent), the segment sums them, builds its part of the filter and answers every
bundle with the exact counts of its words and the levels read for its n-grams. A bundle and its answers
meet by a last shuffle, where texts are scored. N-grams travel as ``GRAM_BITS`` bits besides their segment,
which adds less to the filter's errors than its own; words travel whole.

Defined results:
* a null text is an empty one: it has the end token alone;
* rows are scored row by row, so repeated rows and repeated or null ids get their own results;
* without training texts, N and V are 0 and no token is known; an empty table gives an empty result;
* extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import text as tx
from eventlake.llm.common import crc_remainder, cut, table

_U = np.uint64
END_TOKEN = _U(0x2545F4914F6CDD1D)
START_TOKEN = _U(0xC3A5C85C97CB3127)
#: Bits by which an n-gram is known in its segment.
GRAM_BITS = 34
SMOOTHING = 0.1


@dataclass(frozen=True)
class Settings:
    #: Bits set by a key.
    probes: int = 4
    #: Filter bits to each key, at least.
    room: int = 32
    #: Growth of counts from level to level.
    base: float = 2.0 ** (1 / 8)
    #: Tokens of a bundle of texts (a longer text is one by itself), and of a segment on average, at most.
    bundle_tokens: int = 1 << 21
    segment_tokens: int = 1 << 20
    least_segments: int = 256
    #: Pseudo-counts of the words behind bigrams (m2), and of the bigrams behind trigrams (m3).
    behind_pairs: float = 64.0
    behind_triples: float = 4.0
    #: These bound nothing: sizes follow the counted keys. They are here for callers that name them.
    filter_bits: int = 28
    head_words: int = 1 << 20
    bigram_words: int = 1 << 16


# -- the filter ---------------------------------------------------------------------------------

BLOCK_BITS = 9


@lru_cache
def level_counts(base: float) -> np.ndarray:
    """The least count of each level: each is ``base`` times the one before, and larger by 1 at least."""
    least = [1]
    while least[-1] < 1 << 48:
        least.append(max(least[-1] + 1, int(np.ceil(least[-1] * base))))
    return np.array(least)


def quantised(count: np.ndarray, base: float = 2.0) -> np.ndarray:
    """Levels of counts; with base 2, 1 + floor(log2)."""
    return np.searchsorted(level_counts(base), count, side="right")


def restored(level: np.ndarray, base: float = 2.0) -> np.ndarray:
    """The middle of the counts of a level, on the scale of logarithms; 0 for level 0."""
    least = level_counts(base)
    at = np.clip(np.asarray(level).astype(np.int64), 1, len(least) - 1)
    return np.where(np.asarray(level) > 0, np.sqrt(least[at - 1] * (least[at] - 1.0)), 0.0)


def level_keys(grams: np.ndarray, level: int | np.ndarray) -> np.ndarray:
    return tx.mix64(grams + np.asarray(level).astype(_U) * _U(0xD1B54A32D192ED03))


def _places(keys: np.ndarray, bits: int, probe: int) -> np.ndarray:
    """Bit of one probe in a filter of 2**bits: each key stays in one block of 512 bits."""
    block = keys >> _U(64 - (bits - BLOCK_BITS))
    return ((block << _U(BLOCK_BITS)) | ((keys >> _U(BLOCK_BITS * probe)) & _U((1 << BLOCK_BITS) - 1))).astype(np.int64)


class LogFilter:
    """A filter of distinct n-grams with their counts, sized for its keys."""

    def __init__(self, grams: np.ndarray, n: np.ndarray, s: Settings) -> None:
        level = quantised(n, s.base)
        order = np.argsort(-level, kind="stable")
        grams, level = grams[order], level[order]
        self.probes = s.probes
        self.bits = max(BLOCK_BITS + 1, (s.room * int(level.sum())).bit_length())
        self.words = np.zeros(1 << (self.bits - 3), np.uint8)
        for k in range(1, int(level.max(initial=0)) + 1):
            keys = level_keys(grams[: np.searchsorted(-level, -k, side="right")], k)
            for probe in range(self.probes):
                at = _places(keys, self.bits, probe)
                np.bitwise_or.at(self.words, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        live = np.arange(len(keys))
        for probe in range(self.probes):
            at = _places(keys[live], self.bits, probe)
            live = live[(self.words[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
        out = np.zeros(len(keys), bool)
        out[live] = True
        return out

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """Quantised counts: probes by rising level, until one is missing."""
        out = np.zeros(len(grams), np.int64)
        live = np.arange(len(grams))
        level = 1
        while len(live):
            live = live[self.contains(level_keys(grams[live], level))]
            out[live] = level
            level += 1
        return out


def build_filter(grams: DataFrame, s: Settings) -> LogFilter:
    """A filter of (gram, n) rows that fit the driver, as one segment."""
    got = grams.select("gram", "n").toArrow()
    return LogFilter(got.column("gram").to_numpy().view(_U), got.column("n").to_numpy(), s)


# -- bundles of texts ---------------------------------------------------------------------------


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets of the texts): lower-cased words of each text and its end token."""
    low = tx.lower_bytes(data, latin=False)
    words = tx.split_words(low, offsets)
    hashes = words.hashes(tx.Spans.of(low))
    out = np.insert(hashes, words.first[1:], END_TOKEN)
    return out, words.first + np.arange(words.texts + 1)


def bigrams(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Hash of each token behind the one before it, or behind the start."""
    before = np.full(len(hashes), START_TOKEN)
    before[1:] = hashes[:-1]
    before[begins] = START_TOKEN
    return tx.mix64(before * _U(0x9FB21C651E98DF25) + hashes)


def trigrams(hashes: np.ndarray, pairs: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Hash of each token in ``later`` behind the bigram that the token before it ends."""
    return tx.mix64(pairs[later - 1] * _U(0xA24BAED4963EE407) + hashes[later])


def _pack(values: np.ndarray) -> bytes:
    """Size and compressed bytes of small numbers, their high bytes apart from their low ones."""
    if not len(values):
        return b""
    raw = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(packed: bytes, dtype) -> np.ndarray:
    if not packed:
        return np.zeros(0, dtype)
    raw = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _pack_sorted(values: np.ndarray) -> bytes:
    """Rising numbers by what each adds."""
    return _pack(np.diff(values, prepend=_U(0)))


def _unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed, _U), dtype=_U)


BUNDLES = (
    "doc_id array<long>, held_out array<boolean>, sizes array<long>, words binary, tokens binary, "
    "n_tokens long, train_tokens long, train_texts long"
)


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _bundle_rows(s: Settings):
    """Rows of texts as bundles: distinct words, frequent ones first, and the place of each token's word among them."""

    def bundle(parts: list[tuple]) -> pa.RecordBatch:
        doc_id, held_out = (pa.concat_arrays([p[k] for p in parts]) for k in (0, 1))
        sizes = np.concatenate([p[2] for p in parts])
        word, tokens_at, n = np.unique(np.concatenate([p[3] for p in parts]), return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")  # places of frequent words are small numbers
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        trained = sizes[~held_out.to_numpy(zero_copy_only=False)]
        ends = pa.array([0, len(sizes)], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, x) for x in (doc_id, held_out, pa.array(sizes))]
        blobs = [pa.array([word[order].tobytes()], pa.binary()), pa.array([_pack(place[tokens_at])], pa.binary())]
        return pa.RecordBatch.from_arrays([*lists, *blobs, pa.array([int(sizes.sum())]), pa.array([int(trained.sum())]), pa.array([len(trained)])], _names(BUNDLES))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text")):
                hashes, at = tokens(data, offsets)
                if parts and held + len(hashes) > s.bundle_tokens:
                    yield bundle(parts)
                    parts, held = [], 0
                part = batch.slice(lo, hi - lo)
                parts.append((part.column("doc_id"), part.column("held_out"), np.diff(at), hashes))
                held += len(hashes)
        if parts:
            yield bundle(parts)

    return work


@dataclass
class Bundle:
    """A bundle as read back; words and n-grams are sorted by hash, so those of a segment are neighbours."""

    sizes: np.ndarray
    held_out: np.ndarray
    words: np.ndarray
    #: Of each token, the place of its word.
    at: np.ndarray
    #: Of each token, the place of its bigram.
    pairs: np.ndarray
    pair_at: np.ndarray
    #: Tokens that are not the first of their text, and of each the place of its trigram.
    later: np.ndarray
    triples: np.ndarray
    triple_at: np.ndarray

    @classmethod
    def of(cls, columns: dict) -> Bundle:
        sizes, held_out = np.array(columns["sizes"], np.int64), np.array(columns["held_out"], bool)
        stored = np.frombuffer(columns["words"], _U)
        order = np.argsort(stored)
        words, place = stored[order], np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        at = place[_unpack(columns["tokens"], np.uint32)]
        begins = np.zeros(len(at), bool)
        begins[np.cumsum(sizes) - sizes] = True
        later = np.flatnonzero(~begins)
        behind = bigrams(words[at], begins)
        triples, triple_at = np.unique(trigrams(words[at], behind, later), return_inverse=True)
        pairs, pair_at = np.unique(behind, return_inverse=True)
        return cls(sizes, held_out, words, at, pairs, pair_at, later, triples, triple_at)


# -- counts and the filter's segments -----------------------------------------------------------

KINDS = ("words", "pairs", "triples")
POSTINGS = "bundle long, segment int, words binary, words_n binary, pairs binary, pairs_n binary, triples binary, triples_n binary"
ANSWERS = "bundle long, segment int, words_n binary, pairs_level binary, triples_level binary, distinct long"


def segment_bits(tokens: int, s: Settings) -> int:
    """Segments, as a power of two, for a corpus of so many tokens."""
    return max(s.least_segments - 1, (tokens - 1) // s.segment_tokens).bit_length()


def _posting_rows(bits: int):
    """The distinct n-grams of each bundle with their training counts, by segment."""
    bounds = np.arange(1, 1 << bits, dtype=_U) << _U(64 - bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                b = Bundle.of(row)
                train = np.repeat(~b.held_out, b.sizes)
                counts = (
                    np.bincount(b.at, train, len(b.words)),
                    np.bincount(b.pair_at, train, len(b.pairs)),
                    np.bincount(b.triple_at, train[b.later], len(b.triples)),
                )
                ends = [np.array([0, *np.searchsorted(getattr(b, kind), bounds), len(getattr(b, kind))]) for kind in KINDS]
                some = np.flatnonzero(sum(np.diff(e) for e in ends))
                columns = []
                for kind, n, e in zip(KINDS, counts, ends):
                    grams, n = getattr(b, kind), n.astype(np.uint32)
                    if kind != "words":  # the part of the hash that is not the segment
                        grams = (grams << _U(bits)) >> _U(64 - GRAM_BITS)
                    columns.append(pa.array([_pack_sorted(grams[e[k] : e[k + 1]]) for k in some], pa.binary()))
                    columns.append(pa.array([_pack(n[e[k] : e[k + 1]]) for k in some], pa.binary()))
                ids = [pa.array(np.full(len(some), row["bundle"])), pa.array(some.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(ids + columns, _names(POSTINGS))

    return work


def _summed(grams: list[bytes], n: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(distinct n-grams, their counts, places of each list's n-grams among them)."""
    lists = [_unpack_sorted(g) for g in grams]
    found, inverse = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(inverse, np.concatenate([_unpack(x, np.uint32) for x in n]), len(found)).astype(np.int64)
    return found, total, np.split(inverse, np.cumsum([len(x) for x in lists])[:-1])


def _answers(s: Settings):
    """A segment: its part of the filter, and what it says to each bundle."""

    def work(rows: pa.Table) -> pa.Table:
        got = rows.to_pydict()
        summed = [_summed(got[kind], got[f"{kind}_n"]) for kind in KINDS]
        _, word_n, word_places = summed[0]
        # Bigrams and trigrams are told apart by the bit above those of an n-gram.
        grams = np.concatenate([summed[1][0], summed[2][0] | (_U(1) << _U(GRAM_BITS))])
        n = np.concatenate([summed[1][1], summed[2][1]])
        made = LogFilter(grams[n > 0], n[n > 0], s)
        level = made.levels(grams).astype(np.uint16)
        levels = (level[: len(summed[1][0])], level[len(summed[1][0]) :])
        distinct = np.zeros(len(word_places), np.int64)
        distinct[0] = (word_n > 0).sum()
        blobs = [[_pack(word_n[p]) for p in word_places], *([_pack(x[p]) for p in part[2]] for x, part in zip(levels, summed[1:]))]
        columns = [pa.array(got["bundle"]), pa.array(got["segment"], pa.int32()), *(pa.array(b, pa.binary()) for b in blobs), pa.array(distinct)]
        return pa.Table.from_arrays(columns, _names(ANSWERS))

    return work


# -- scoring ------------------------------------------------------------------------------------

SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def interpolated(count: np.ndarray, context: np.ndarray, lower: np.ndarray, behind: float) -> np.ndarray:
    """Chances of one order: counts of n-grams and of their contexts, with pseudo-counts of the order below."""
    return (np.minimum(count, context) + behind * lower) / (context + behind)


def _score_bundle(bottom: float, train_texts: int, s: Settings):
    def work(bundle: pa.Table, answers: pa.Table) -> pa.Table:
        row = bundle.to_pylist()[0]
        b = Bundle.of(row)
        got = answers.sort_by("segment").to_pydict()
        exact = np.concatenate([_unpack(x, np.int64) for x in got["words_n"]])
        pair, triple = (restored(np.concatenate([_unpack(x, np.uint16) for x in got[k]]), s.base) for k in ("pairs_level", "triples_level"))
        word = exact[b.at]
        alone = (word + SMOOTHING) / bottom
        pair = pair[b.pair_at]
        before = np.full(len(word), float(train_texts))
        before[b.later] = word[b.later - 1]
        chance = interpolated(pair, before, alone, s.behind_pairs)
        chance[b.later] = interpolated(triple[b.triple_at], pair[b.later - 1], chance[b.later], s.behind_triples)
        n = len(b.sizes)
        owner = np.repeat(np.arange(n), b.sizes)
        base = np.bincount(owner, np.log10(alone), n)
        known = np.bincount(owner, word > 0, n).astype(np.int64)
        score = np.bincount(owner, np.log10(chance), n)
        columns = [pa.array(row["doc_id"], pa.int64()), pa.array(b.held_out), pa.array(b.sizes), pa.array(known), pa.array(base), pa.array(score)]
        return pa.Table.from_arrays(columns, _names(SCORED))

    return work


def score(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: token counts, base score and the model's score."""
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", (crc_remainder(F.col("doc_id"), 10) == 0).alias("held_out")
    )
    bundles = cut(base.mapInArrow(_bundle_rows(s), BUNDLES).withColumn("bundle", F.monotonically_increasing_id()))
    sums = bundles.agg(F.sum("n_tokens").alias("all"), F.sum("train_tokens").alias("train"), F.sum("train_texts").alias("texts")).first()
    bits = segment_bits(sums["all"] or 0, s)
    postings = bundles.mapInArrow(_posting_rows(bits), POSTINGS)
    answers = cut(postings.groupBy("segment").applyInArrow(_answers(s), ANSWERS))
    train, distinct = int(sums["train"] or 0), int(answers.agg(F.sum("distinct")).first()[0] or 0)
    bottom = train + SMOOTHING * (distinct + 1)
    scored = bundles.groupBy("bundle").cogroup(answers.groupBy("bundle")).applyInArrow(_score_bundle(bottom, int(sums["texts"] or 0), s), SCORED)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(train).cast("long").alias("train_tokens"), "base_score", "score")


def op6_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
