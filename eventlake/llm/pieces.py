"""Operator 4: SentencePiece encoding and decoding by batched numpy Viterbi.

The model is a byte-fallback BPE model. Its encoding of a word is the only segmentation in which every
pair of neighbouring pieces is *stable*: merging their characters in the model's order never joins them.
So the encoding of each prefix ends in one piece, and a Viterbi pass finds it: at each position, among
the pieces that end there and are stable behind the last piece of the prefix before them, the longest is
kept as the backpointer. Distinct words of one length advance together: substring hashes probe the sorted
piece keys (behind a bit table that rejects most non-pieces), and the maxima are taken over whole columns.

Long words are encoded by windows that overlap and advance together like words of one length. Two windows
join at a boundary that both have, if the pieces on its sides are stable: then all neighbours are, so the
joined pieces are the word's encoding. Where windows share no such boundary, the later one begins anew at a
boundary of the earlier; a word for which that fails too is encoded in one piece.

Words are cut where no piece can reach across: before a space mark and around characters without a
piece, which become bytes. Runs of space marks are merged after the words, as the model does. Results
equal those of the SentencePiece library for this kind of model; ``Vocabulary`` refuses models it can't
treat exactly.

Defined results:
* a null text has null ids, an empty one has none; decoding gives the same back;
* encoding loses one thing: the space mark U+2581 in a text is decoded as a space;
* repeated rows are encoded alike; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm import text as tx
from eventlake.llm.common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = 0x2581
#: Distinct words that a Python worker remembers.
CACHE_WORDS = 1_000_000
#: Pairs of pieces that it remembers, as a power of two.
PAIR_BITS = 20
SLICE_BYTES = 1 << 20
#: Characters of words that are encoded by windows, of a window, and of what two windows share.
LONG_WORD = 1024
WINDOW = 512
SHARED = 128

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)


def merge(symbols: list[str], rank: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Plain BPE: join the best-ranked neighbours, the leftmost of equals, until none is left."""
    last = None
    symbols = list(symbols)
    while len(symbols) > 1:
        scored = [(rank.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
        best, at = max(scored)
        if best == -np.inf:
            break
        at = -at
        last = (symbols[at], symbols[at + 1])
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols, last


def _code_hash(codes: np.ndarray) -> np.ndarray:
    return tx.mix64(codes.astype(_U) + _U(1))


@dataclass
class Vocabulary:
    """The pieces of a model with what encoding and decoding need; small, and sent to every worker."""

    texts: list[str]
    scores: list[float]
    byte_ids: list[int]

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts, scores, byte_ids = [], [], [0] * 256
        for i in range(model.get_piece_size()):
            special = model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
            if model.is_byte(i):
                byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
            texts.append("" if special else model.id_to_piece(i))
            scores.append(model.get_score(i))
        if not any(byte_ids):
            raise ValueError("the model has no byte pieces")
        return cls(texts, scores, byte_ids)

    @cached_property
    def rank(self) -> dict[str, float]:
        return {t: s for t, s in zip(self.texts, self.scores) if t}

    @cached_property
    def number(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.texts) if t}

    @cached_property
    def space(self) -> int:
        return self.number[chr(SPACE)]

    def prepare(self) -> Tables:
        return Tables.of(self)


@dataclass
class Tables:
    """Arrays for the Viterbi pass, built once in the driver."""

    keys: np.ndarray  # sorted hashes of the pieces that encode to themselves
    ids: np.ndarray
    likely: np.ndarray  # bit table over the low bits of the keys
    reach: np.ndarray  # longest piece with an ending of three characters, by the ending's hash
    longest: int
    single: np.ndarray  # code point -> piece id, or -1
    formed: np.ndarray  # score at which a piece is formed; characters are there from the start
    left: np.ndarray
    right: np.ndarray
    pair_keys: np.ndarray  # sorted left * 2**32 + right of neighbours that can be joined
    pair_score: np.ndarray
    byte_ids: np.ndarray
    length: np.ndarray  # characters of each piece
    space: int
    runs: dict[int, list[int]]
    spell: np.ndarray  # bytes of all pieces, and offsets
    spell_at: np.ndarray
    texts: list[str]
    rank: dict[str, float]
    encoder: Encoder | None = None  # of a Python worker, for all its tasks

    BITS = 22
    ENDING = 3
    ENDING_BITS = 20

    @classmethod
    def of(cls, v: Vocabulary) -> Tables:
        n = len(v.texts)
        mark = chr(SPACE)
        left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        formed = np.full(n, np.inf)
        own, pairs = [], {}
        for i, t in enumerate(v.texts):
            if not t:
                continue
            for k in range(1, len(t)):
                a, b = v.number.get(t[:k]), v.number.get(t[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = v.scores[i]
            if mark in t[1:]:
                if t.strip(mark):
                    raise ValueError(f"piece {t!r} has a space mark inside")
                continue  # runs of space marks are merged by themselves
            if len(t) == 1:
                own.append(i)
                continue
            parts, last = merge(list(t), v.rank)
            if len(parts) == 1:
                a, b = v.number.get(last[0]), v.number.get(last[1])
                if a is None or b is None or v.scores[i] >= min(formed_score(v, a), formed_score(v, b)):
                    raise ValueError(f"piece {t!r} is ranked before its parts")
                left[i], right[i], formed[i] = a, b, v.scores[i]
                own.append(i)
        longest = max(len(v.texts[i]) for i in own)
        reach = np.zeros(1 << cls.ENDING_BITS, np.uint8)
        for i in own:
            if len(v.texts[i]) >= cls.ENDING:
                at = _text_key(v.texts[i][-cls.ENDING :]) & ((1 << cls.ENDING_BITS) - 1)
                reach[at] = max(reach[at], len(v.texts[i]))
        keys = np.array([_text_key(v.texts[i]) for i in own], _U)
        order = np.argsort(keys)
        likely = np.zeros(1 << cls.BITS, bool)
        likely[keys & _U((1 << cls.BITS) - 1)] = True
        single = np.full(0x110000, -1, np.int32)
        for i in own:
            if len(v.texts[i]) == 1:
                single[ord(v.texts[i])] = i
        pair_keys = np.array(sorted(pairs), np.int64)
        spelled = [b""] * n
        for i, t in enumerate(v.texts):
            spelled[i] = t.replace(mark, " ").encode()
        for byte, i in enumerate(v.byte_ids):
            spelled[i] = bytes([byte])
        at = np.zeros(n + 1, np.int64)
        np.cumsum([len(s) for s in spelled], out=at[1:])
        return cls(
            keys[order], np.array(own)[order], likely, reach, longest, single, formed, left, right, pair_keys,
            np.array([pairs[k] for k in pair_keys.tolist()]), np.array(v.byte_ids), np.array([len(t) for t in v.texts]), v.space, {},
            np.frombuffer(b"".join(spelled), np.uint8), at, v.texts, v.rank,
        )

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes, -1 where there is none."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.likely[hashes & _U((1 << self.BITS) - 1)])
        at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == hashes[maybe]
        out[maybe[hit]] = self.ids[at[hit]]
        return out

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the boundary between pieces a and b is never merged over.

        The pieces on both sides of the boundary are followed back in time: the one formed last is
        undone first. While a pair faces each other, joining it would win if its score beats those
        at which either side grows on; of equal scores the leftmost wins.
        """
        out = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        grown_a, grown_b = np.full(len(a), -np.inf), np.full(len(a), -np.inf)
        while len(live):
            key = a << 32 | b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            joined = self.pair_keys[at] == key
            score = np.where(joined, self.pair_score[at], -np.inf)
            broken = joined & (score > grown_a) & (score >= grown_b)
            out[live[broken]] = False
            when_a, when_b = self.formed[a], self.formed[b]
            more = ~broken & ~(np.isinf(when_a) & np.isinf(when_b))
            undo_a = when_a < when_b
            grown_a = np.where(undo_a, when_a, grown_a)[more]
            grown_b = np.where(undo_a, grown_b, when_b)[more]
            a, b = np.where(undo_a, self.right[a], a)[more], np.where(undo_a, b, self.left[b])[more]
            live = live[more]
        return out

    def space_run(self, n: int) -> list[int]:
        """Pieces of a run of space marks."""
        if n not in self.runs:
            number = {t: i for i, t in enumerate(self.texts) if t}
            longest = max(len(t) for t in self.texts if t and not t.strip(chr(SPACE)))
            # Long runs repeat: the model joins pairs from the left, so a whole number of the longest runs comes first.
            whole = max(0, n // longest - 2) * longest
            parts, _ = merge([chr(SPACE)] * (n - whole), self.rank)
            self.runs[n] = [number[chr(SPACE) * longest]] * (whole // longest) + [number[p] for p in parts]
        return self.runs[n]


def formed_score(v: Vocabulary, i: int) -> float:
    return np.inf if len(v.texts[i]) == 1 else v.scores[i]


def _prefixes(codes: np.ndarray) -> np.ndarray:
    """Prefix sums for substring hashes, along the last axis."""
    power, _ = tx._power_tables(codes.shape[-1] + 1)
    out = np.zeros((*codes.shape[:-1], codes.shape[-1] + 1), _U)
    np.cumsum(_code_hash(codes) * power[: codes.shape[-1]], axis=-1, out=out[..., 1:])
    return out


def _between(prefix: np.ndarray, start: int | np.ndarray, end: int | np.ndarray, inverse: np.ndarray) -> np.ndarray:
    return tx.mix64((prefix[..., end] - prefix[..., start]) * inverse[start])


def _text_key(text: str) -> int:
    codes = np.array([ord(c) for c in text], np.uint32)
    _, inverse = tx._power_tables(len(codes) + 1)
    return int(_between(_prefixes(codes), np.array([0]), np.array([len(codes)]), inverse)[0])


class Encoder:
    """Encodes batches of texts; remembers words and stable pairs between batches."""

    def __init__(self, tables: Tables) -> None:
        self.t = tables
        self.pairs = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_ok = np.zeros(1 << PAIR_BITS, bool)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, _U)
        self.place = np.zeros(0, np.int64)
        self.at = np.zeros(1, np.int64)
        self.tokens = np.zeros(0, np.int32)

    def _stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether boundaries are stable, remembered in a table with one place for each hash."""
        key = a << 32 | b
        slot = ((key.view(_U) * _MULT) >> _U(64 - PAIR_BITS)).astype(np.int64)
        miss = np.flatnonzero(self.pairs[slot] != key)
        ok = self.pair_ok[slot]
        if len(miss):
            fresh, inverse = np.unique(key[miss], return_inverse=True)
            found = self.t.stable(fresh >> 32, fresh & 0xFFFFFFFF)
            ok[miss] = found[inverse]
            slot = ((fresh.view(_U) * _MULT) >> _U(64 - PAIR_BITS)).astype(np.int64)
            _, last = np.unique(slot[::-1], return_index=True)
            last = len(slot) - 1 - last
            self.pairs[slot[last]], self.pair_ok[slot[last]] = fresh[last], found[last]
        return ok

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words of one length (words x length): all pieces in a row, and how many by word."""
        n, length = codes.shape
        prefix = _prefixes(codes)
        _, inverse = tx._power_tables(length + 1)
        last = np.full((length + 1, n), -1, np.int64)
        back = np.zeros((length + 1, n), np.int32)
        for end in range(1, length + 1):
            rows, reach = np.arange(n), None
            for size in range(1, min(end, self.t.longest) + 1):
                if size == self.t.ENDING:
                    ending = _between(prefix, end - size, end, inverse)
                    reach = self.t.reach[ending & _U((1 << self.t.ENDING_BITS) - 1)]
                if reach is not None:
                    rows = rows[reach[rows] >= size]
                    if not len(rows):
                        break
                piece = self.t.probe(_between(prefix if reach is None else prefix[rows], end - size, end, inverse))
                hit = np.flatnonzero(piece >= 0)
                found, piece = rows[hit], piece[hit]
                if size < end and len(found):
                    before = last[end - size, found]
                    ok = before >= 0
                    found, piece, before = found[ok], piece[ok], before[ok]
                    ok = self._stable(before, piece)
                    found, piece = found[ok], piece[ok]
                last[end, found] = piece
                back[end, found] = size
        # Follow the backpointers of all words together, from the end.
        at, found, rows = np.full(n, length), [], np.arange(n)
        while len(rows):
            found.append((rows, last[at[rows], rows]))
            at[rows] -= back[at[rows], rows]
            rows = rows[at[rows] > 0]
        owner = np.concatenate([r for r, _ in found[::-1]])
        piece = np.concatenate([p for _, p in found[::-1]])
        order = np.argsort(owner, kind="stable")
        return piece[order].astype(np.int32), np.bincount(owner, minlength=n)

    def _long(self, codes: np.ndarray) -> np.ndarray:
        """Pieces of a long word, joined from those of its windows."""
        n = len(codes)
        starts = np.append(np.arange(0, n - WINDOW, WINDOW - SHARED), n - WINDOW)
        windows = []
        for at in range(0, len(starts), 4096):
            got, counts = self.viterbi(codes[starts[at : at + 4096][:, None] + np.arange(WINDOW)])
            windows += np.split(got, np.cumsum(counts)[:-1])
        again: dict[bytes, np.ndarray] = {}
        pieces, ends = windows[0], np.cumsum(self.t.length[windows[0]])
        out, joined = [], 0
        for start, fresh in zip(starts[1:].tolist(), windows[1:]):
            begins = start + np.append(0, np.cumsum(self.t.length[fresh]))[:-1]
            both, i, j = np.intersect1d(ends, begins, return_indices=True)
            ok = np.flatnonzero((both > max(start, joined)) & self._stable(pieces[i].astype(np.int64), fresh[j].astype(np.int64)))
            if len(ok):
                k = ok[len(ok) // 2]
                last, first = i[k], j[k]
            else:
                for last in np.flatnonzero(ends > max(start, joined))[:-1].tolist():
                    part = codes[ends[last] : ends[last] + WINDOW]
                    fresh = again.get(part.tobytes())
                    if fresh is None:
                        fresh = again[part.tobytes()] = self.viterbi(part[None, :])[0]
                    if self._stable(pieces[last : last + 1].astype(np.int64), fresh[:1].astype(np.int64))[0]:
                        break
                else:
                    return self.viterbi(codes[None, :])[0]
                first, begins = 0, ends[last] + np.append(0, np.cumsum(self.t.length[fresh]))[:-1]
            out.append(pieces[(ends > joined) & (np.arange(len(ends)) <= last)])
            joined = int(ends[last])
            pieces, ends = fresh, begins + self.t.length[fresh]
        return np.concatenate([*out, pieces[ends > joined]])

    def _learn(self, codes: np.ndarray, start: np.ndarray, size: np.ndarray, keys: np.ndarray) -> None:
        """Encode new distinct words and remember them."""
        pieces, counts, order = [], [], []
        for length in np.unique(size):
            rows = np.flatnonzero(size == length)
            if length > LONG_WORD:
                for row in rows:
                    pieces.append(self._long(codes[start[row] : start[row] + length]))
                    counts.append(np.array([len(pieces[-1])]))
                    order.append(np.array([row]))
                continue
            step = max(1, 4_000_000 // int(length))
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                got, n = self.viterbi(codes[start[part][:, None] + np.arange(length)])
                pieces.append(got)
                counts.append(n)
                order.append(part)
        if not order:
            return
        place = len(self.at) - 1 + np.arange(len(keys))
        self.tokens = np.concatenate([self.tokens, *pieces])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(np.concatenate(counts))])
        fresh = keys[np.concatenate(order)]
        sort = np.argsort(fresh)
        at = np.searchsorted(self.known, fresh[sort])
        self.known, self.place = np.insert(self.known, at, fresh[sort]), np.insert(self.place, at, place[sort])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and offsets of the texts."""
        n = len(offsets) - 1
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        at = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=at[1:])
        first = at[offsets]
        some = np.flatnonzero(np.diff(first) > 0)
        # A space mark goes in front of each text.
        codes = np.insert(points, first[some], SPACE)
        codes[codes == 0x20] = SPACE
        moved = np.searchsorted(some, np.arange(n + 1))
        first = first + moved
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        strange = self.t.single[codes] < 0
        cut = (codes == SPACE) | strange
        cut[1:] |= strange[:-1]
        cut[first[some]] = True
        start = np.flatnonzero(cut)
        size = np.diff(np.append(start, len(codes)))
        plain = ~strange[start]
        prefix = _prefixes(codes)
        _, inverse = tx._power_tables(len(codes) + 1)
        key = tx.mix64((prefix[start + size] - prefix[start]) * inverse[start] + size.astype(_U))
        distinct, index = np.unique(key[plain], return_index=True)
        if len(self.known) + len(distinct) > CACHE_WORDS:
            self._forget()
        fresh = index[~self._is_known(distinct)]
        where = np.flatnonzero(plain)[fresh]
        self._learn(codes, start[where], size[where], key[where])
        # Pieces of each word: from memory, or the bytes of a character without a piece.
        place = self.place[np.searchsorted(self.known, key[plain])]
        counts = np.zeros(len(start), np.int64)
        counts[plain] = np.diff(self.at)[place]
        odd = [np.frombuffer(chr(c).encode("utf-8", "replace"), np.uint8) for c in codes[start[~plain]].tolist()]
        counts[~plain] = [len(o) for o in odd]
        to = np.zeros(len(start) + 1, np.int64)
        np.cumsum(counts, out=to[1:])
        out = np.zeros(to[-1], np.int32)
        step = np.arange(to[-1]) - np.repeat(to[:-1], counts)
        source = np.zeros(len(start), np.int64)
        source[plain] = self.at[place]
        from_memory = np.repeat(plain, counts)
        out[from_memory] = self.tokens[(np.repeat(source, counts) + step)[from_memory]]
        if odd:
            out[~from_memory] = self.t.byte_ids[np.concatenate(odd)]
        ends = to[np.searchsorted(start, first)]
        return self._merge_spaces(out, ends)

    def _is_known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(keys), bool)
        return self.known[np.minimum(np.searchsorted(self.known, keys), len(self.known) - 1)] == keys

    def _merge_spaces(self, out: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join runs of lone space marks inside each text."""
        lone = out == self.t.space
        begin = lone.copy()
        begin[1:] &= ~lone[:-1]
        inner = offsets[(offsets > 0) & (offsets < len(out))]
        begin[inner] = lone[inner]
        start = np.flatnonzero(begin)
        if not len(start):
            return out, offsets
        stop = np.flatnonzero(~lone | begin)
        after = np.searchsorted(stop, start, side="right")
        end = np.append(stop, len(out))[after]
        long = np.flatnonzero(end - start > 1)
        if not len(long):
            return out, offsets
        keep = np.ones(len(out), bool)
        shorter = np.zeros(len(out) + 1, np.int64)
        for i in long:
            pieces = self.t.space_run(int(end[i] - start[i]))
            out[start[i] : start[i] + len(pieces)] = pieces
            keep[start[i] + len(pieces) : end[i]] = False
            shorter[end[i]] += end[i] - start[i] - len(pieces)
        gone = np.cumsum(shorter)
        return out[keep], offsets - gone[offsets]


def decode_ids(ids: np.ndarray, offsets: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and offsets of the texts, without the space put in front."""
    size = np.diff(t.spell_at)[ids]
    at = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    data = t.spell[np.repeat(t.spell_at[ids] - at[:-1], size) + np.arange(at[-1])]
    ends = at[offsets]
    front = ends[:-1][np.diff(ends) > 0]
    front = front[data[front] == 0x20]
    drop = np.zeros(len(data) + 1, np.int64)
    drop[front + 1] = 1
    keep = np.ones(len(data), bool)
    keep[front] = False
    return data[keep], ends - np.cumsum(drop)[ends]


@lru_cache(maxsize=2)
def tables_of(path: str = MODEL) -> Tables:
    """The tables of a model, built once in a driver."""
    return Vocabulary.load(path).prepare()


def _lists(values: np.ndarray, offsets: np.ndarray, nulls: pa.Array) -> pa.Array:
    flat = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, pa.int32()))
    if nulls.null_count == 0:
        return flat
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, pa.int32()), mask=nulls.is_null())


def encode(docs: DataFrame, tables: Tables) -> DataFrame:
    """``docs`` with ``token_ids`` in place of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(tables)
    rest = [c for c in docs.columns if c not in ("text", "token_ids")]
    schema = T.StructType([*docs.select(*rest).schema.fields, T.StructField("token_ids", T.ArrayType(T.IntegerType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = sent.value
        encoder = tables.encoder = tables.encoder or Encoder(tables)
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                ids, at = encoder.encode(data, offsets)
                part = batch.slice(lo, hi - lo)
                lists = _lists(ids, at, part.column("text"))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), lists], [*rest, "token_ids"])

    return docs.select(*rest, "text").mapInArrow(work, schema)


def decode(tokens: DataFrame, tables: Tables) -> DataFrame:
    """``tokens`` with ``text`` in place of ``token_ids``."""
    sent = tokens.sparkSession.sparkContext.broadcast(tables)
    rest = [c for c in tokens.columns if c not in ("text", "token_ids")]
    schema = T.StructType([*tokens.select(*rest).schema.fields, T.StructField("text", T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                column = part.column("token_ids")
                at = np.zeros(part.num_rows + 1, np.int64)
                np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), out=at[1:])
                data, offsets = decode_ids(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), at, sent.value)
                view = memoryview(data)
                texts = [bytes(view[offsets[i] : offsets[i + 1]]).decode("utf-8", "replace") for i in range(part.num_rows)]
                text = pa.array(texts, pa.string(), mask=column.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), text], [*rest, "text"])

    return tokens.select(*rest, "token_ids").mapInArrow(work, schema)


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and whether decoding them gives its text back."""
    tables = tables_of()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.md5(F.col("text").cast("binary")).alias("before"))
    coded = encode(docs, tables).withColumn("ids", F.col("token_ids"))
    back = decode(coded, tables)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.col("ids").alias("token_ids"),
        F.col("before").eqNullSafe(F.md5(F.col("text").cast("binary"))).alias("round_trip"),
    )
