"""Operator 3: quality rules with compression bands.

Whole documents and their fixed chunks are compressed with zstandard. Natural text of a given length and
language compresses to a ratio inside a narrow band; repeated or patterned text (junk tables, symbol noise)
falls below it, and encoded or random text lies above it. A document is rejected if its own ratio is outside
the band of its length, or if more than a share of its bytes lies in chunks outside the chunk band. Simple
counts (words, symbols, repeated lines, words in repeated 8-word windows) form the base rules in front.

Bands are learned by language (and one for all) from documents labelled good, at most ``Rules.sample`` rows
drawn by hash: a curve of the ratio over the logarithm of the length, and quantiles of what good documents
differ from it, by length. Beyond the lengths seen, bands go on straight and widen. Without enough labels,
the fixed limits of ``Bands`` count. Every text is judged in full; chunks cover all of its bytes.

Judging is per document, so the scan is the only stage: no shuffle, and memory is bounded by one slice of
texts (or one long text).

Defined results:
* a null text has no words, and so fails the base rules like an empty one;
* texts below the first band's length have no compression verdict, as the frame of the compressor
  outweighs them; they are kept unless the base rules fail;
* a null language, one without learned bands, and a table without ``lang`` use the bands of all languages;
* a document is good if a label says so and none says otherwise; labels without an id teach nothing;
* repeated rows are judged row by row; further columns of the input are ignored; an empty table gives
  an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import text as tx
from eventlake.llm.common import cut, small, table

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30


@dataclass(frozen=True)
class Bands:
    """Fixed limits of compressed size / size. ``whole``: (bytes from, least, most) by rising length."""

    level: int = 3
    whole: tuple[tuple[int, float, float], ...] = (
        (128, 0.35, 1.05),
        (512, 0.30, 0.80),
        (2048, 0.26, 0.74),
        (16384, 0.22, 0.70),
        (65536, 0.18, 0.70),
    )
    chunk_bytes: int = 2048
    least_chunk_bytes: int = 1024
    chunk: tuple[float, float] = (0.30, 0.74)
    most_bad_share: float = 0.25

    def limits(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) ratio of texts of these sizes; shorter texts than the first band have none."""
        at = np.searchsorted([b[0] for b in self.whole], sizes, side="right") - 1
        least, most = np.array([b[1] for b in self.whole])[at], np.array([b[2] for b in self.whole])[at]
        return np.where(at >= 0, least, -np.inf), np.where(at >= 0, most, np.inf)


@dataclass(frozen=True)
class Rules:
    """How bands are learned."""

    #: Labelled good rows to learn from, at most; those a band needs; those of a part of its lengths.
    sample: int = 6000
    least_rows: int = 100
    part_rows: int = 150
    #: Share of good documents outside on each side, a margin, and what a band widens by octave beyond its lengths.
    outside: float = 0.003
    margin: float = 0.004
    widening: float = 0.03


@dataclass(frozen=True)
class Learned(Bands):
    """Limits that follow the length: a curve of the ratio over log2(bytes), and limits around it at knots."""

    curve: tuple[float, ...] = ()
    knots: tuple[float, ...] = ()
    below: tuple[float, ...] = ()
    above: tuple[float, ...] = ()
    widening: float = 0.03

    def limits(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.log2(np.maximum(sizes, 1))
        inside = np.clip(x, self.knots[0], self.knots[-1])
        beyond = x - inside
        middle = np.polyval(self.curve, inside) + np.polyval(np.polyder(self.curve), inside) * beyond
        wider = self.widening * np.abs(beyond)
        least = middle + np.interp(inside, self.knots, self.below) - wider
        most = middle + np.interp(inside, self.knots, self.above) + wider
        judged = sizes >= self.whole[0][0]
        return np.where(judged, least, -np.inf), np.where(judged, most, np.inf)


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, bad_chunk_share double"
)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    run = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=run[1:])
    return run[offsets[1:]] - run[offsets[:-1]]


def _keyed(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts."""
    return tx.mix64(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def repeated_lines(words: tx.Words, spans: tx.Spans) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, by text."""
    data, offsets = words.data, words.offsets
    breaks = np.flatnonzero(data == 0x0A)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    end = np.sort(np.concatenate([offsets[1:], breaks]))
    some = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end = start[some], end[some]
    owner = np.searchsorted(offsets, start, side="right") - 1
    kept, index = np.unique(_keyed(owner, spans.hash(start, end)), return_index=True)
    lines = np.bincount(owner, minlength=words.texts)
    return lines - np.bincount(owner[index], minlength=words.texts)


def repeated_words(words: tx.Words, hashes: np.ndarray) -> np.ndarray:
    """Words that lie in a window found twice or more in their text, by text."""
    found, first = tx.window_hashes(words, hashes, WINDOW)
    owner = words.owner()
    key = _keyed(owner[first], found)
    ordered = np.sort(key)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(words.texts, np.int64)
    at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    hit = first[twice[at] == key]
    change = np.zeros(len(hashes) + 1, np.int64)
    change[hit] += 1
    np.subtract.at(change, hit + WINDOW, 1)
    return np.bincount(owner[np.cumsum(change[:-1]) > 0], minlength=words.texts)


def chunk_starts(size: int, bands: Bands) -> list[int]:
    """Where fixed chunks begin; a short rest belongs to the chunk before it."""
    starts = list(range(0, size, bands.chunk_bytes))
    return starts[:-1] if len(starts) > 1 and size - starts[-1] < bands.least_chunk_bytes else starts


def ratios(data: np.ndarray, offsets: np.ndarray, bands: Bands) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(ratio of each text, sizes of its chunks, ratios of its chunks); texts without a chunk's bytes have no chunks."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=bands.level, write_content_size=False).compress
    n = len(offsets) - 1
    whole, sizes, parts = np.zeros(n), [], []
    view = memoryview(data)
    for i in range(n):
        text = view[offsets[i] : offsets[i + 1]]
        size = len(text)
        if size:
            whole[i] = len(pack(text)) / size
        starts = chunk_starts(size, bands) if size >= bands.least_chunk_bytes else []
        ends = [*starts[1:], size]
        sizes.append(np.array([b - a for a, b in zip(starts, ends)]))
        parts.append(np.array([len(pack(text[a:b])) / (b - a) for a, b in zip(starts, ends)]))
    return whole, sizes, parts


def compression(
    data: np.ndarray, offsets: np.ndarray, bands: Bands, langs: list | None = None, learned: dict | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ratio, share of bytes in bad chunks, verdict) of each text; ``learned`` has the bands of languages, None for all."""
    whole, sizes, parts = ratios(data, offsets, bands)
    n = len(whole)
    bad, good = np.zeros(n), np.ones(n, bool)
    learned = learned or {None: bands}
    kinds = np.array([lang if lang in learned else "" for lang in (langs or [None] * n)], object)
    for kind in set(kinds.tolist()):
        at = np.flatnonzero(kinds == kind)
        rules = learned[kind] if kind in learned else learned[None]
        least, most = rules.limits(np.diff(offsets)[at])
        good[at] = ((whole[at] >= least) & (whole[at] <= most)) | (whole[at] == 0)
        for i in at:
            if len(parts[i]):
                outside = (parts[i] < rules.chunk[0]) | (parts[i] > rules.chunk[1])
                bad[i] = sizes[i][outside].sum() / sizes[i].sum()
                good[i] &= bad[i] <= rules.most_bad_share
    return whole, bad, good


# -- learning -----------------------------------------------------------------------------------


def fit_band(sizes: np.ndarray, whole: np.ndarray, low: np.ndarray, high: np.ndarray, bands: Bands, rules: Rules) -> Learned:
    """The band of good texts: their sizes and ratios, and the least and largest ratio of their chunks (or NaN)."""
    order = np.argsort(sizes, kind="stable")
    x, y = np.log2(sizes[order]), whole[order]
    curve = np.polyfit(x, y, 2)
    off = y - np.polyval(curve, x)
    groups = np.array_split(np.arange(len(x)), max(1, len(x) // rules.part_rows))
    knots = np.array([np.median(x[g]) for g in groups])
    below = np.array([np.quantile(off[g], rules.outside) for g in groups]) - rules.margin
    above = np.array([np.quantile(off[g], 1 - rules.outside) for g in groups]) + rules.margin
    chunk = bands.chunk
    if np.isfinite(low).sum() >= rules.least_rows:
        chunk = (float(np.nanquantile(low, rules.outside)) - rules.margin, float(np.nanquantile(high, 1 - rules.outside)) + rules.margin)
    return Learned(
        bands.level, bands.whole, bands.chunk_bytes, bands.least_chunk_bytes, chunk, bands.most_bad_share,
        tuple(curve), tuple(knots), tuple(below), tuple(above), rules.widening,
    )


def _lang(docs: DataFrame) -> Column:
    return docs["lang"].cast("string") if "lang" in docs.columns else F.lit(None).cast("string")


def learn(docs: DataFrame, labels: DataFrame, bands: Bands = Bands(), rules: Rules = Rules()) -> dict[str | None, Bands]:
    """Bands by language from documents labelled good; under None that of all languages.

    Of the rows that share an id, one is learned from: that of the least (size, ratios, language).
    """
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good"))
    sample = cut(known.where("good = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rules.sample).select(F.col("doc_id").alias("id")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text")):
                words = tx.split_words(data, offsets)
                failed = base_failed(words, repeated_words(words, words.hashes()))
                size = np.diff(offsets)
                whole, _, parts = ratios(data, offsets, bands)
                low = np.array([p.min() if len(p) else np.nan for p in parts])
                high = np.array([p.max() if len(p) else np.nan for p in parts])
                some = ~failed & (size >= bands.whole[0][0])
                columns = [batch.column(c).slice(lo, hi - lo) for c in ("id", "lang")] + [pa.array(c) for c in (size, whole, low, high)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "lang", "size", "whole", "low", "high"]).filter(pa.array(some))

    rows = docs.select(F.col("doc_id").alias("id"), "text", _lang(docs).alias("lang")).where("text IS NOT NULL")
    rows = rows.join(small(sample, sample.count()), "id", "left_semi").select(F.col("id").cast("long").alias("id"), "text", "lang")
    made = rows.mapInArrow(work, "id long, lang string, size long, whole double, low double, high double")
    one = made.groupBy("id").agg(F.min(F.struct("size", "whole", "low", "high", "lang")).alias("r"))
    got = one.select("r.*").toPandas()  # at most Rules.sample rows
    got = got.sort_values(["size", "whole", "low", "high"])
    groups = {None: got} | {lang: part for lang, part in got.groupby("lang")}
    return {None: bands} | {
        lang: fit_band(*(part[c].to_numpy() for c in ("size", "whole", "low", "high")), bands, rules)
        for lang, part in groups.items()
        if len(part) >= rules.least_rows
    }


def base_failed(words: tx.Words, repeats: np.ndarray) -> np.ndarray:
    n = words.counts.astype(np.int64)
    return (n < LEAST_WORDS) | (100 * repeats > MOST_REPEATED_PERCENT * n)


def _verdicts(batch: pa.RecordBatch, bands: Bands, learned: dict | None) -> Iterator[tuple]:
    """(rows from, rows to, words, spans, repeated words, base_failed, ratio, bad share, kept) of slices."""
    for lo, hi, data, offsets in tx.slices(batch.column("text")):
        words = tx.split_words(data, offsets)
        spans = tx.Spans.of(data)
        repeats = repeated_words(words, words.hashes(spans))
        failed = base_failed(words, repeats)
        langs = batch.column("lang").slice(lo, hi - lo).to_pylist()
        ratio, bad, good = compression(data, offsets, bands, langs, learned)
        yield lo, hi, words, spans, repeats, failed, ratio, bad, good & ~failed


def judge(docs: DataFrame, bands: Bands = Bands(), learned: dict[str | None, Bands] | None = None) -> DataFrame:
    """One row per document: counts, base verdict, compression ratios and verdict."""
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS)] = True

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, words, spans, repeats, failed, ratio, bad, kept in _verdicts(batch, bands, learned):
                data, offsets = words.data, words.offsets
                points = _per_text((data & 0xC0) != 0x80, offsets) - _per_text(tx._IS_SEP[data], offsets)
                counts = (words.counts, points, _per_text(symbols[data], offsets), repeated_lines(words, spans), repeats)
                columns = [batch.column("doc_id").slice(lo, hi - lo), *(pa.array(x.astype(np.int64)) for x in counts)]
                columns += [pa.array(failed), pa.array(kept), pa.array(ratio), pa.array(bad)]
                names = [field.split()[0] for field in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text", _lang(docs).alias("lang")).mapInArrow(work, SCHEMA)


def keep_good(docs: DataFrame, bands: Bands = Bands(), learned: dict[str | None, Bands] | None = None) -> DataFrame:
    """The rows of ``docs`` that are judged kept, each by its own text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row")
            names = [rows.type.field(i).name for i in range(rows.type.num_fields)]
            for lo, hi, *_, kept in _verdicts(batch, bands, learned):
                part = pa.RecordBatch.from_arrays(rows.slice(lo, hi - lo).flatten(), names)
                yield part.filter(pa.array(kept))

    return docs.select(F.struct("*").alias("row"), "text", _lang(docs).alias("lang")).mapInArrow(work, docs.schema)


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, learned=learn(docs, table(spark, sf_dir, "labels")))
