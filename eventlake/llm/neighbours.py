"""Operator 1: nearest neighbours by a block matrix join of int8 product tiles.

Equal vectors are one node, known by its least ids: as ties go to smaller ids, no more than k + 1 of them can
be among the nearest of any query. Nodes are quantised to int8 codes with a scale each; ``x = scale * code + e``.
For a query and a candidate, the product of codes gives the inner product up to ``|q'||e_x| + |e_q||x|``, a bound
that is known for each pair. Queries and candidates are dealt to blocks by hash, and each pair of a query
block and a candidate block is one cell with a bounded number of bytes; only codes and bounds are sent there.
In a cell, tiles of code products give lower and upper bounds; a pair whose upper bound is below its query's
(k + 1)-th best lower bound can't be among the nearest. Lower bounds of all cells together discard more; the
pairs that survive meet their original vectors, are computed again in double precision, and are merged by a
heap for each query. The result is exact: bounds only ever discard pairs that can't win, so recall against
brute force is 1.

Defined results:
* rows with a null id, or a vector that is null, empty, zero, or holds a null or non-finite
  component, take no part;
* of rows with equal ids, the one with the smallest vector counts;
* vectors of different lengths are not compared;
* an empty table, or one without queries, gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm.common import cut, parallelism, small, table


@dataclass(frozen=True)
class Blocks:
    k: int = 20
    #: Most rows of a block, on average.
    query_rows: int = 4096
    candidate_rows: int = 65536
    #: Bytes of the codes of a block, on average, at most.
    block_bytes: int = 16 << 20
    #: Fewest candidates of a block, on average, where there are enough partitions for more blocks.
    least_rows: int = 1024
    #: Sides of a tile.
    tile_queries: int = 512
    tile_candidates: int = 4096


ENCODED = "vec_id long, dim int, vector binary"
CODES = "node string, dim int, codes binary, scale double, norm double, code_norm double, error_norm double, is_query boolean, is_candidate boolean"
BOUNDS = "query string, node string, low double, high double"
#: Products of int8 codes summed over so many dimensions are exact in single precision.
EXACT_DIMENSIONS = 1024


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scales, error norms) of the rows of x."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = np.finfo(np.float64).tiny
    codes = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    return codes, scale, np.linalg.norm(x - codes * scale[:, None], axis=1)


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes, so that equal ones are equal; a negative zero is a zero."""
    for batch in batches:
        vectors = batch.column("vector")
        size = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
        x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
        raw = [v.tobytes() for v in np.split(x, np.cumsum(size)[:-1])] if len(size) else []
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(size), pa.array(raw, pa.binary())], _names(ENCODED))


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column("dim").to_numpy()
        for dim in np.unique(sizes):
            part = batch.filter(pa.array(sizes == dim))
            x = np.frombuffer(b"".join(part.column("vector").to_pylist()), np.float64).reshape(-1, dim)
            codes, scale, error = quantise(x)
            columns = [part.column("node"), part.column("dim"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale)]
            columns += [pa.array(np.linalg.norm(x, axis=1)), pa.array(np.linalg.norm(codes * scale[:, None], axis=1)), pa.array(error)]
            columns += [part.column("is_query"), part.column("is_candidate")]
            yield pa.RecordBatch.from_arrays(columns, _names(CODES))


def encode(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Valid vectors, one row for each id, as bytes and with the node that equal ones share."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    valid = v.isNotNull() & finite & F.exists(v, lambda x: x != 0) & F.col("vec_id").isNotNull()
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    return rows.where(valid).groupBy("vec_id").agg(F.min("vector").alias("vector")).mapInArrow(_encode, ENCODED).withColumn("node", F.md5("vector"))


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 codes held as single-precision numbers."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_DIMENSIONS):
        out += a[:, at : at + EXACT_DIMENSIONS] @ b[:, at : at + EXACT_DIMENSIONS].T
    return out


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed in the order of components, so that equal pairs give equal scores."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def _stack(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    codes = np.frombuffer(b"".join(rows["codes"]), np.int8).reshape(len(rows), -1)
    return rows["node"].to_numpy(object), codes, *(rows[c].to_numpy() for c in ("scale", "norm", "code_norm", "error_norm"))


def _search_cell(rules: Blocks):
    """Pairs of a cell that may be among the nearest, with their bounds."""

    def work(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(candidates):
            q, c = _stack(queries), _stack(candidates)
            for lo in range(0, len(q[0]), rules.tile_queries):
                out.append(_search_tiles(tuple(x[lo : lo + rules.tile_queries] for x in q), c, rules))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, object)] * 2 + [np.zeros(0)] * 2
        return pd.DataFrame({name: pd.Series(x, dtype=x.dtype) for name, x in zip(_names(BOUNDS), columns)})

    return work


def _search_tiles(q: tuple, c: tuple, rules: Blocks) -> tuple[np.ndarray, ...]:
    """(query, node, low, high) of the pairs of some queries with all candidates that survive."""
    ids, codes, scale, norm, code_norm, error = q
    codes = codes.astype(np.float32)
    best = np.full((len(ids), rules.k + 1), -np.inf)  # the largest lower bounds so far
    found = []
    for at in range(0, len(c[0]), rules.tile_candidates):
        _, c_codes, c_scale, c_norm, _, c_error = (x[at : at + rules.tile_candidates] for x in c)
        about = code_products(codes, c_codes.astype(np.float32)) * (scale[:, None] * c_scale[None, :])
        bound = code_norm[:, None] * c_error[None, :] + error[:, None] * c_norm[None, :] + 1e-12 * norm[:, None] * c_norm[None, :]
        low, high = about - bound, about + bound
        best = np.partition(np.concatenate([best, low], axis=1), -rules.k - 1, axis=1)[:, -rules.k - 1 :]
        row, column = np.nonzero(high >= best[:, :1])
        found.append((row, at + column, low[row, column], high[row, column]))
    row, column, low, high = (np.concatenate(x) for x in zip(*found))
    stay = high >= best[row, 0]
    row, column = row[stay], column[stay]
    return ids[row], c[0][column], low[stay], high[stay]


def survivors(codes: DataFrame, rules: Blocks) -> DataFrame:
    """(query, node): all pairs of nodes that may be among the nearest; ``codes`` has flags of both sides."""
    facts = codes.agg(F.count_if("is_candidate"), F.count_if("is_query"), F.max("dim")).first()
    n, n_queries, dim = (x or 0 for x in facts)
    block = lambda most: max(1, min(most, rules.block_bytes // max(1, dim)))
    # Few candidates make few cells, however many partitions there are: each cell returns k rows a query and more.
    columns = max(1, -(-n // block(rules.candidate_rows)), min(parallelism(codes.sparkSession), -(-n // rules.least_rows)))
    rows = max(1, -(-n_queries // block(rules.query_rows)))
    # Each side is sent to every cell of its row or column of the grid.
    left = codes.where("is_query").withColumn("qb", F.pmod(F.xxhash64("node"), F.lit(rows)).cast("int"))
    left = left.withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    right = codes.where("is_candidate").withColumn("cb", F.pmod(F.xxhash64("node", F.lit(7)), F.lit(columns)).cast("int"))
    right = right.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
    cell = ["dim", "qb", "cb"]
    found = cut(left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(_search_cell(rules), BOUNDS))
    if columns == 1:
        return found.select("query", "node")
    # The (k + 1)-th lower bound over all cells of a query; Spark limits ranks before the shuffle.
    by_low = Window.partitionBy("query").orderBy(F.col("low").desc())
    top = found.select("query", "low", F.row_number().over(by_low).alias("rank")).where(F.col("rank") <= rules.k + 1)
    floor = top.groupBy("query").agg(F.when(F.count("*") > rules.k, F.min("low")).otherwise(float("-inf")).alias("floor"))
    return found.join(floor, "query").where(F.col("high") >= F.col("floor")).select("query", "node")


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column("dim").to_numpy()
        for dim in np.unique(sizes):
            part = batch.filter(pa.array(sizes == dim))
            a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.float64).reshape(-1, dim) for c in ("query_vector", "vector"))
            yield pa.RecordBatch.from_arrays([part.column("query"), part.column("ids"), pa.array(inner_products(a, b))], ["query", "ids", "score"])


BEST = "query string, best array<struct<score: double, vec_id: long>>"


def _merge(rules: Blocks):
    """The best ids of each query, from rows sorted by query: a heap takes the scores of its nodes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, heap = None, []
        schema = pa.schema([("query", pa.string()), ("best", pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64())])))])

        def close() -> pa.RecordBatch:
            best = [{"score": score, "vec_id": -i} for score, i in sorted(heap, reverse=True)]
            return pa.RecordBatch.from_pylist([{"query": query, "best": best}], schema)

        for batch in batches:
            done = []
            for q, score, ids in zip(*(batch.column(c).to_pylist() for c in ("query", "score", "ids"))):
                if q != query:
                    if query is not None:
                        done.append(close())
                    query, heap = q, []
                for i in ids:
                    if len(heap) <= rules.k:
                        heapq.heappush(heap, (score, -i))
                    elif (score, -i) > heap[0]:
                        heapq.heapreplace(heap, (score, -i))
                    else:
                        break  # ids rise
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if query is not None:
            yield close()

    return work


def nearest(candidates: DataFrame, queries: DataFrame, rules: Blocks = Blocks()) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest candidates of each query; both sides encoded."""
    both = candidates.withColumn("query", F.lit(False)).unionByName(queries.withColumn("query", F.lit(True)))
    nodes = cut(
        both.groupBy("node").agg(
            F.first("dim").alias("dim"), F.first("vector").alias("vector"), F.bool_or("query").alias("is_query"), F.bool_or(~F.col("query")).alias("is_candidate")
        )
    )
    least = Window.partitionBy("node").orderBy("vec_id")
    ids = candidates.select("node", "vec_id", F.row_number().over(least).alias("place")).where(F.col("place") <= rules.k + 1)
    ids = ids.groupBy("node").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    codes = cut(nodes.mapInArrow(_codes, CODES))
    pairs = survivors(codes, rules)
    vectors = nodes.select("node", "dim", "vector")
    scored = (
        pairs.join(vectors.join(ids, "node"), "node")
        .join(vectors.select(F.col("node").alias("query"), F.col("vector").alias("query_vector")), "query")
        .select("query", "ids", "dim", "query_vector", "vector")
        .mapInArrow(_scores, "query string, ids array<long>, score double")
    )
    best = cut(scored.repartition("query").sortWithinPartitions("query").mapInArrow(_merge(rules), BEST))
    # A query's own id is no candidate.
    own = queries.select(F.col("vec_id").alias("query_id"), F.col("node").alias("query")).join(small(best, best.count()), "query")
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, rules.k)
    ranked = own.select("query_id", F.posexplode(others).alias("place", "x"))
    return ranked.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cut(encode(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, min(embedding::DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
  GROUP BY vec_id),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
