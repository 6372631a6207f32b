"""Operator 12: hard negatives by integer inner products in a residue number system.

Components are scaled and floored to integers. Products of component matrices are taken modulo several odd primes
below 258: residues lie around zero, so a single-precision product of 1,024 of them is exact, and as many primes
are used as the largest norms of a cell of rows need. The residues of a score are its digits in a mixed radix
after Chinese remaindering, and centred digits carry the sign, so scores are exact 64-bit integers.

Anchors and rows are dealt to blocks by hash; each pair of blocks is one cell of bounded rows and bytes. A first
grid, by label, finds the best rows of each anchor's label (its positives). A second grid, over all rows, meets
anchors that carry the scores of their positives: of the rows with another label, a cell returns the first few
inside each positive's window, from four fifths of its score up to it. A cell returns no more than ``positives * k`` rows of an anchor,
however many rows tie; windows by rank merge them, and Spark limits ranks before the shuffle.

Defined results:
* rows with a null id, label or vector, or with a null or non-finite component, take no part; nor do vectors whose
  scaled norm is 2**31 or more, as a 64-bit integer can't hold their scores;
* of rows with equal ids, the one with the smallest (vector, label) counts;
* vectors of different lengths are not compared; empty vectors score 0 with each other;
* a positive with a negative score has no window, so no negatives; an anchor without positives has no rows;
* an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm.common import cut, parallelism, small, table

#: Products of so many centred residues modulo primes below 258 add up to at most 2**24: exact in single precision.
EXACT_DIMENSIONS = 1024
LARGEST_PRIME = 257


@dataclass(frozen=True)
class Mining:
    scale: float = 256.0
    positives: int = 5
    negatives: int = 5
    #: Negatives score at least the positive's score less one of so many parts of it: four fifths.
    parts: int = 5
    #: Most rows of a block, on average, and most bytes of its codes.
    anchor_rows: int = 2048
    candidate_rows: int = 32768
    block_bytes: int = 16 << 20
    #: Fewest candidates of a block, on average, where there are partitions for more blocks.
    least_rows: int = 2048
    tile_anchors: int = 256
    tile_candidates: int = 4096


ROWS = "vec_id long, label long, dim int, codes binary"
POSITIVES = "anchor_id long, positive_id long, score long"
NEGATIVES = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


# -- residues -----------------------------------------------------------------------------------


@cache
def primes() -> tuple[int, ...]:
    """Odd primes up to LARGEST_PRIME, the largest first."""
    return tuple(n for n in range(LARGEST_PRIME, 2, -2) if all(n % d for d in range(3, int(n**0.5) + 1, 2)))


def primes_for(bound: float) -> tuple[int, ...]:
    """The fewest primes whose product tells all integers up to ``bound`` in size apart."""
    product, used = 1, []
    for p in primes():
        used.append(p)
        product *= p
        if product > 2 * bound + 1:
            return tuple(used)
    raise ValueError("the bound is too large")


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """Integers held as floats, modulo p, as residues from -(p - 1) / 2 to (p - 1) / 2."""
    return x - p * np.rint(x / p)


def residues(codes: np.ndarray, moduli: tuple[int, ...]) -> list[np.ndarray]:
    x = codes.astype(np.float64)
    return [centred(x, p).astype(np.float32) for p in moduli]


def product_modulo(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo p for matrices of residues, by exact single-precision products."""
    total = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, a.shape[1], EXACT_DIMENSIONS):
        part = a[:, at : at + EXACT_DIMENSIONS] @ b[:, at : at + EXACT_DIMENSIONS].T
        # A quotient may come close to a half, so it is taken in double precision.
        total += centred(part.astype(np.float64), p).astype(np.float32)
        total = centred(total, p)
    return total


def reconstruct(parts: list[np.ndarray], moduli: tuple[int, ...]) -> np.ndarray:
    """Integers from their residues: mixed-radix digits around zero, weighed by the products of the primes before."""
    digits: list[np.ndarray] = []
    for p, part in zip(moduli, parts):
        digit = part
        for q, earlier in zip(moduli, digits):
            digit = centred((digit - earlier) * np.float32(pow(q, -1, p)), p)
        digits.append(digit)
    out, weight = np.zeros(parts[0].shape, np.int64), 1
    for p, digit in zip(moduli, digits):
        # Products wrap modulo 2**64; the sum is right as the integer itself fits.
        out += digit.astype(np.int64) * np.array(weight % (1 << 64), np.uint64).view(np.int64)
        weight *= p
    return out


def integer_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two integer matrices."""
    bound = float(_norms(a).max(initial=0)) * float(_norms(b).max(initial=0))
    moduli = primes_for(bound * (1 + 1e-9) + 1)
    return reconstruct([product_modulo(x, y, p) for p, x, y in zip(moduli, residues(a, moduli), residues(b, moduli))], moduli)


def _norms(codes: np.ndarray) -> np.ndarray:
    return np.linalg.norm(codes.astype(np.float64), axis=1)


# -- cells --------------------------------------------------------------------------------------


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _stack(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, codes) in the order of ids, so that ties in a row of scores are in their order."""
    rows = rows.sort_values("vec_id")
    codes = np.frombuffer(b"".join(rows["codes"]), np.int32).reshape(len(rows), -1)
    return rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), codes


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    begins = np.flatnonzero(np.r_[True, np.diff(group[order]) != 0]) if len(order) else np.zeros(0, int)
    within = np.arange(len(order)) - np.repeat(begins, np.diff(np.r_[begins, len(order)]))
    return order[within < k]


def _frame(schema: str, columns: list[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame({name: pd.Series(x, dtype="int64") for name, x in zip(_names(schema), columns)})


def _tiles(a: np.ndarray, b: np.ndarray, rules: Mining, moduli: tuple[int, ...]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first anchor, first candidate, scores) of the tiles of a cell, anchor by anchor tile."""
    right = residues(b, moduli)
    for i in range(0, len(a), rules.tile_anchors):
        left = residues(a[i : i + rules.tile_anchors], moduli)
        for j in range(0, len(b), rules.tile_candidates):
            parts = [product_modulo(x, y[j : j + rules.tile_candidates], p) for p, x, y in zip(moduli, left, right)]
            yield i, j, reconstruct(parts, moduli)


def _moduli(a: np.ndarray, b: np.ndarray) -> tuple[int, ...]:
    return primes_for(float(_norms(a).max()) * float(_norms(b).max()) * (1 + 1e-9) + 1)


def _positive_cell(rules: Mining):
    """The best rows of each anchor in a cell of one label."""

    def work(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(anchors) or not len(rows):
            return _frame(POSITIVES, [np.zeros(0)] * 3)
        (a_ids, _, a), (ids, _, b) = _stack(anchors), _stack(rows)
        best = [np.zeros(0, np.int64)] * 3
        for i, j, scores in _tiles(a, b, rules, _moduli(a, b)):
            # Not fewer than k + 1, as the anchor itself is among the rows.
            k = min(rules.positives + 1, scores.shape[1])
            floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
            r, c = np.nonzero(scores >= floor[:, None])
            other = a_ids[i + r] != ids[j + c]
            r, c = r[other], c[other]
            found = [np.concatenate(x) for x in zip(best, (a_ids[i + r], ids[j + c], scores[r, c]))]
            keep = _first(found[0], found[2], found[1], rules.positives)
            best = [x[keep] for x in found]
        return _frame(POSITIVES, best)

    return work


def _negative_cell(rules: Mining):
    """The first rows of other labels inside the window of each positive of the anchors of a cell."""

    def work(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(anchors) or not len(rows):
            return _frame(NEGATIVES, [np.zeros(0)] * 5)
        anchors = anchors.sort_values("vec_id")
        (a_ids, a_labels, a), (ids, labels, b) = _stack(anchors), _stack(rows)
        count = anchors["positive_ids"].map(len).to_numpy()
        owner = np.repeat(np.arange(len(anchors)), count)
        p_ids, high = (np.concatenate(anchors[c].to_list()).astype(np.int64) for c in ("positive_ids", "scores"))
        low = high - high // rules.parts
        first = np.r_[0, np.cumsum(count)]
        most, least = np.maximum.reduceat(high, first[:-1]), np.minimum.reduceat(low, first[:-1])
        best = [np.zeros(0, np.int64)] * 3  # positive's place, negative's id, score
        for i, j, scores in _tiles(a, b, rules, _moduli(a, b)):
            some = slice(i, i + len(scores))
            inside = (scores <= most[some, None]) & (scores >= least[some, None]) & (labels[None, j : j + scores.shape[1]] != a_labels[some, None])
            r, c = np.nonzero(inside)
            found = [best]
            for n in range(rules.positives):  # the n-th positive of each anchor
                place = first[i + r] + n
                has = place < first[i + r + 1]
                place, s, at = place[has], scores[r[has], c[has]], ids[j + c[has]]
                fits = (s <= high[place]) & (s >= low[place])
                keep = _first(place[fits], s[fits], at[fits], rules.negatives)
                found.append([x[fits][keep] for x in (place, at, s)])
            joined = [np.concatenate(x) for x in zip(*found)]
            keep = _first(joined[0], joined[2], joined[1], rules.negatives)
            best = [x[keep] for x in joined]
        place, negative, score = best
        return _frame(NEGATIVES, [a_ids[owner[place]], p_ids[place], high[place], negative, score])

    return work


# -- jobs ---------------------------------------------------------------------------------------


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("vector")
        size = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
        codes = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        raw = [v.tobytes() for v in np.split(codes, np.cumsum(size)[:-1])] if len(size) else []
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(size), pa.array(raw, pa.binary())], _names(ROWS))


def encode(vectors: DataFrame, vec_id: Column, label: Column, vector: Column, rules: Mining = Mining()) -> DataFrame:
    """Rows that take part, one for each id: id, label, length and integer codes."""
    rows = vectors.select(vec_id.cast("long").alias("vec_id"), label.cast("long").alias("label"), vector.cast("array<double>").alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & whole)
    # A double's floor that is no long would saturate, so sizes are judged before.
    scaled = rows.withColumn("v", F.transform("v", lambda x: x * F.lit(rules.scale)))
    fits = F.aggregate("v", F.lit(0.0), lambda sum_, x: sum_ + (F.abs(x) + 1) * (F.abs(x) + 1)) < F.lit(2.0**62)
    coded = scaled.where(fits).withColumn("v", F.transform("v", lambda x: F.floor(x).cast("int")))
    one = coded.groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("row"))
    return one.select("vec_id", F.col("row.label").alias("label"), F.col("row.v").alias("vector")).mapInArrow(_encode, ROWS)


def _grid(anchors: DataFrame, rows: DataFrame, keys: list[str], rules: Mining) -> tuple:
    """Both sides dealt to cells: anchors to a row of the grid of their keys, rows to a column, each sent along it.

    ``keys`` hold ``dim``. Few rows make few cells, however many partitions there are, as each cell returns rows of all its anchors.
    """
    bound = lambda most: F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.lit(rules.block_bytes) / F.greatest(F.lit(1), 4 * F.col("dim")))))
    blocks = lambda n, most: F.greatest(F.lit(1), F.ceil(n / bound(most)))
    counted = lambda df: df.groupBy(*keys).agg(F.count("*").alias("n"))
    spread = F.least(F.lit(parallelism(rows.sparkSession)), F.ceil(F.col("n") / rules.least_rows))
    tall = counted(anchors).select(*keys, blocks(F.col("n"), rules.anchor_rows).cast("int").alias("tall"))
    wide = counted(rows).select(*keys, F.greatest(spread, blocks(F.col("n"), rules.candidate_rows)).cast("int").alias("wide"))
    shape = cut(tall.join(wide, keys))
    shape = small(shape, shape.count())
    dealt = lambda name, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.col(name)).cast("int")
    along = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    left = anchors.join(shape, keys).withColumn("row", dealt("tall", 1)).withColumn("column", along("wide"))
    right = rows.join(shape, keys).withColumn("column", dealt("wide", 2)).withColumn("row", along("tall"))
    # Both sides may come from one table, so one gets columns of its own.
    return left.toDF(*left.columns).groupBy(*keys, "row", "column"), right.groupBy(*keys, "row", "column")


def mine(rows: DataFrame, anchors: DataFrame, rules: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores; both sides are rows of :func:`encode`."""
    left, right = _grid(anchors, rows, ["dim", "label"], rules)
    found = left.cogroup(right).applyInPandas(_positive_cell(rules), POSITIVES)
    best = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), "positive_id")
    positives = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= rules.positives).where("score >= 0")
    listed = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "score")).alias("p"))
    armed = cut(anchors.join(listed, "vec_id").select(*anchors.columns, F.col("p.positive_id").alias("positive_ids"), F.col("p.score").alias("scores")))
    left, right = _grid(armed, rows, ["dim"], rules)
    found = left.cogroup(right).applyInPandas(_negative_cell(rules), NEGATIVES)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rules.negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = cut(encode(table(spark, sf_dir, "embeddings"), F.col("vec_id"), label, F.col("embedding")))
    return mine(rows, rows.where("vec_id % 100 = 0"))


ORACLE = """
WITH c AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM c a JOIN c b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT *, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id)::INTEGER AS rank FROM n
QUALIFY rank <= 5
"""
