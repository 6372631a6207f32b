"""Operator 13: ranked lexical search by Block-Max MaxScore over shards of an inverted index.

Documents are dealt to shards as they are read, each with a bounded number of documents and bytes. A shard's index has
a row for each term: its postings (gap and occurrences as variable-length integers) in compressed blocks, and for
each block its last document, most occurrences and shortest document. These do not depend on the rest of the
table, so the index is made in one scan; the documents and occurrences of all shards, from which weights follow, are
summed from its rows.

Each shard is searched for all items. An item's lists are ordered by their global bounds: those whose bounds together
stay below the worst score in the item's heap are non-essential. Essential lists are read window by window; their
documents are candidates. Block maxima of the non-essential lists are added to a candidate's score, and it is
rejected if it can't reach the heap, before any of these blocks is decompressed; the others are read from the list
with the largest bound on, and candidates fall away after each. Heaps of shards are merged by rank.

Only lists of the items' terms are indexed; items are searched in rounds of a bounded number of terms, which is what
goes to the driver and the workers. The result is exact: bounds only reject documents that can't be among the best.

Defined results:
* a null text has no terms; documents without terms count nowhere and are never found;
* rows that share an id are documents of their own; null ids come last among equal scores;
* rows of items are items of their own, whatever their id; an item without known terms has no rows;
* a term in all documents may weigh 0; documents with score 0 are left out;
* an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from eventlake.llm import text as tx
from eventlake.llm.common import cut, table


@dataclass(frozen=True)
class Search:
    k: int = 10
    #: Documents and bytes of text of a shard, at most (a longer text may exceed the bytes).
    shard_docs: int = 16384
    shard_bytes: int = 32 << 20
    #: Postings of a block, and documents of a shard that are looked at together.
    block: int = 64
    window: int = 4096
    #: Terms of the items of a round, on average, at most.
    round_terms: int = 1_000_000


INDEX = pa.schema([
    ("shard", pa.int64()), ("term", pa.int64()), ("df", pa.int64()), ("total", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
    ("last", pa.list_(pa.int32())), ("most", pa.list_(pa.int64())), ("least", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32())), ("payload", pa.binary()),
])
INDEX_DDL = "shard long, term long, df long, total long, ids array<long>, sizes array<long>, last array<int>, most array<long>, least array<long>, ends array<int>, payload binary"
FOUND = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
FOUND_DDL = "item long, item_id long, doc_id long, score long"


# -- postings -----------------------------------------------------------------------------------


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, length of each) of non-negative integers: seven bits a byte, the lowest first, a high bit if more follow."""
    length = np.ones(len(values), np.int64)
    for k in range(1, 6):
        length += values >= 1 << (7 * k)
    begins = np.cumsum(length) - length
    out = np.zeros(int(length.sum()), np.uint8)
    for k in range(int(length.max(initial=0))):
        has = length > k
        out[begins[has] + k] = ((values[has] >> (7 * k)) & 127) | np.where(length[has] > k + 1, 128, 0)
    return out, length


def unpack(data: np.ndarray) -> np.ndarray:
    if not len(data):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(data < 128)
    begins = np.r_[0, ends[:-1] + 1]
    shift = 7 * (np.arange(len(data)) - np.repeat(begins, ends - begins + 1))
    return np.add.reduceat((data & 127).astype(np.int64) << shift, begins)


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values).cast(kind))


class _Shard:
    """Postings of the documents read so far, and their rows of the index."""

    def __init__(self, vocabulary: np.ndarray, rules: Search):
        self.vocabulary, self.rules = vocabulary, rules
        self.ids, self.sizes, self.parts, self.docs, self.bytes = [], [], [], 0, 0

    def add(self, ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> None:
        words = tx.split_terms(data, offsets)
        if len(self.vocabulary):
            h = words.hashes()
            at = np.searchsorted(self.vocabulary, h).clip(max=len(self.vocabulary) - 1)
            known = self.vocabulary[at] == h
            pairs, tf = np.unique(at[known] * words.texts + words.owner()[known], return_counts=True)
            self.parts.append((pairs // words.texts, self.docs + pairs % words.texts, tf))
        self.ids.append(ids)
        self.sizes.append(words.counts.astype(np.int64))
        self.docs, self.bytes = self.docs + words.texts, self.bytes + len(data)

    @property
    def full(self) -> bool:
        return self.docs >= self.rules.shard_docs or self.bytes >= self.rules.shard_bytes

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        sizes = np.concatenate(self.sizes)
        one = {"shard": shard, "df": int((sizes > 0).sum()), "total": int(sizes.sum()), "ids": pa.concat_arrays(self.ids).to_pylist(), "sizes": sizes.tolist()}
        yield pa.RecordBatch.from_pylist([one], INDEX)
        term, doc, tf = (np.concatenate(x) for x in zip(*self.parts)) if self.parts else (np.zeros(0, np.int64),) * 3
        if not len(term):
            return
        order = np.lexsort((doc, term))
        term, doc, tf = term[order], doc[order], tf[order]
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        df = np.diff(np.r_[first, len(term)])
        within = np.arange(len(term)) - np.repeat(first, df)
        begins = np.flatnonzero(within % self.rules.block == 0)
        gaps = np.diff(np.r_[-1, doc])
        gaps[first] = doc[first] + 1
        raw, length = pack(np.column_stack([gaps, tf]).ravel())
        bytes_to = np.r_[0, np.cumsum(length)][::2]  # in front of each posting, and the end
        blocks = np.diff(np.r_[np.searchsorted(begins, first), len(begins)])
        block_end = np.r_[begins[1:], len(term)]
        ends = bytes_to[block_end] - np.repeat(bytes_to[first], blocks)
        payload = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(np.r_[bytes_to[first], len(raw)].astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())])
        none = pa.nulls(len(first), pa.list_(pa.int64()))
        columns = [
            pa.array(np.full(len(first), shard)), pa.array(self.vocabulary[term[first]].view(np.int64)), pa.array(df), pa.nulls(len(first), pa.int64()), none, none,
            _lists(doc[block_end - 1], blocks, pa.int32()), _lists(np.maximum.reduceat(tf, begins), blocks, pa.int64()),
            _lists(np.minimum.reduceat(sizes[doc], begins), blocks, pa.int64()), _lists(ends, blocks, pa.int32()), payload,
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=INDEX)


def build(docs: DataFrame, vocabulary: np.ndarray, rules: Search = Search()) -> DataFrame:
    """The index of documents (doc_id, text) for the sorted hashes of terms: rows by shard and term, and one of each shard's documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, made = TaskContext.get().partitionId(), 0
        shard = _Shard(shared.value, rules)
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text")):
                # Slices are bounded by bytes, so many short texts are cut here.
                for at in range(lo, hi, rules.shard_docs):
                    to = min(hi, at + rules.shard_docs)
                    part = offsets[at - lo : to - lo + 1]
                    shard.add(batch.column("doc_id").slice(at, to - at), data[part[0] : part[-1]], part - part[0])
                    if shard.full:
                        yield from shard.rows((place << 32) + made)
                        shard, made = _Shard(shared.value, rules), made + 1
        yield from shard.rows((place << 32) + made)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, INDEX_DDL)


# -- search -------------------------------------------------------------------------------------


def term_weight(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What occurrences are worth in a document, times a term's weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_factor(sizes: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    return 10 + (90 * sizes * n_docs) // max(1, total)


class _List:
    """A term's postings in a shard; blocks are decompressed only when they are read."""

    def __init__(self, weight: int, row: dict, factor: np.ndarray, least: np.ndarray):
        self.weight, self.factor = weight, factor
        self.last, self.ends, self.payload = row["last"], row["ends"], row["payload"]
        self.maxima = weight * impact(row["most"], least)
        self.bound = int(self.maxima.max())
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def read(self, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the blocks from ``begin`` to before ``end``."""
        data = self.payload[self.ends[begin - 1] if begin else 0 : self.ends[end - 1]]
        pairs = unpack(data).reshape(-1, 2)
        docs = np.cumsum(pairs[:, 0]) + (self.last[begin - 1] if begin else -1)
        return docs, self.weight * impact(pairs[:, 1], self.factor[docs])

    def window(self, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) inside a window; kept, as items share terms."""
        if begin not in self.windows:
            a, b = np.searchsorted(self.last, [begin, end - 1])
            docs, scores = self.read(a, min(b + 1, len(self.last))) if a < len(self.last) else (np.zeros(0, np.int64),) * 2
            inside = (docs >= begin) & (docs < end)
            self.windows[begin] = docs[inside], scores[inside]
        return self.windows[begin]

    def most_at(self, docs: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores of documents, from the maxima of the blocks they would be in."""
        at = np.searchsorted(self.last, docs)
        return np.where(at < len(self.last), self.maxima[at.clip(max=len(self.last) - 1)], 0)

    def score_at(self, docs: np.ndarray) -> np.ndarray:
        """Scores of documents (rising); reads only the blocks that may hold one."""
        out = np.zeros(len(docs), np.int64)
        at = np.searchsorted(self.last, docs)
        blocks = np.unique(at[at < len(self.last)])
        for run in np.split(blocks, np.flatnonzero(np.diff(blocks) > 1) + 1) if len(blocks) else []:
            found, scores = self.read(run[0], run[-1] + 1)
            place = np.searchsorted(found, docs).clip(max=len(found) - 1)
            out += np.where(found[place] == docs, scores[place], 0)
        return out


def best_of_shard(lists: list[_List], n_docs: int, rank: np.ndarray, rules: Search) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the k best of a shard, by score and then ``rank``."""
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: x.bound)
    upto = np.cumsum([x.bound for x in lists])
    docs = scores = np.zeros(0, np.int64)
    for begin in range(0, n_docs if lists else 0, rules.window):
        end = min(begin + rules.window, n_docs)
        floor = max(1, int(scores[-1])) if len(scores) == rules.k else 1
        essential = int(np.searchsorted(upto, floor))  # lists before this one can't reach the heap together
        sums = np.zeros(end - begin, np.int64)
        for x in lists[essential:]:
            at, s = x.window(begin, end)
            sums[at - begin] += s
        found = np.flatnonzero(sums)
        sums, found = sums[found], found + begin
        rest = np.zeros((essential + 1, len(found)), np.int64)  # bounds of the first lists, together
        for i, x in enumerate(lists[:essential]):
            rest[i + 1] = rest[i] + x.most_at(found)
        for i in range(essential, -1, -1):
            stay = sums + rest[i] >= floor
            sums, found, rest = sums[stay], found[stay], rest[: i + 1, stay]
            if i and len(found):
                sums = sums + lists[i - 1].score_at(found)
        docs, scores = np.r_[docs, found], np.r_[scores, sums]
        best = np.lexsort((rank[docs], -scores))[: rules.k]
        docs, scores = docs[best], scores[best]
    return docs, scores


def _search(items: list[tuple[int, int | None, np.ndarray]], vocabulary: np.ndarray, weights: np.ndarray, n_docs: int, total: int, rules: Search):
    def work(rows: pa.Table) -> pa.Table:
        ids = sizes = None
        lists: dict[int, dict] = {}
        for batch in rows.to_batches():
            for i in range(batch.num_rows):
                if not batch.column("term")[i].is_valid:
                    ids = batch.column("ids")[i].values
                    sizes = np.array(batch.column("sizes")[i].values)
                    continue
                at = int(np.searchsorted(vocabulary, np.uint64(batch.column("term")[i].as_py() % (1 << 64))))
                row = {c: np.array(batch.column(c)[i].values).astype(np.int64) for c in ("last", "most", "least", "ends")}
                lists[at] = row | {"payload": np.frombuffer(batch.column("payload")[i].as_buffer(), np.uint8)}
        factor = length_factor(sizes, n_docs, total)
        known = np.array(ids.is_valid())
        values = np.array(ids.fill_null(0))
        rank = np.empty(len(values), np.int64)
        rank[np.lexsort((values, ~known))] = np.arange(len(values))
        made = {at: _List(int(weights[at]), row, factor, length_factor(row["least"], n_docs, total)) for at, row in lists.items()}
        out = []
        for number, item_id, terms in items:
            docs, scores = best_of_shard([made[t] for t in terms.tolist() if t in made], len(values), rank, rules)
            if len(docs):
                repeat = lambda x: pa.array([x] * len(docs), pa.int64())  # noqa: E731, B023
                out.append(pa.RecordBatch.from_arrays([repeat(number), repeat(item_id), ids.take(pa.array(docs)), pa.array(scores)], schema=FOUND))
        return pa.Table.from_batches(out, schema=FOUND)

    return work


def item_terms(items: DataFrame) -> DataFrame:
    """Items (item_id, text) with the hashes of their terms."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text")):
                words = tx.split_terms(data, offsets)
                h, first = words.hashes().view(np.int64), words.first
                terms = [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(lo, hi - lo), pa.array(terms, pa.list_(pa.int64()))], ["item_id", "terms"])

    return items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(work, "item_id long, terms array<long>")


def rank(docs: DataFrame, items: DataFrame, rules: Search = Search()) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of each item."""
    spark = docs.sparkSession
    # Numbers are given to rows of a checkpoint, so they stay the same.
    coded = cut(item_terms(items)).withColumn("item", F.monotonically_increasing_id())
    terms = coded.agg(F.sum(F.size("terms"))).first()[0] or 0
    rounds = max(1, -(-terms // rules.round_terms))
    found = spark.createDataFrame([], FOUND_DDL)
    for n in range(rounds):
        rows = coded.where(F.pmod(F.xxhash64("item"), F.lit(rounds)) == n).collect()
        hashes = [np.array(r["terms"], np.int64).view(np.uint64) for r in rows]
        vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        if not len(vocabulary):
            continue
        index = cut(build(docs, vocabulary, rules))
        stats = {r["term"]: r for r in index.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total")).collect()}
        if None not in stats:
            continue
        n_docs, total = stats[None]["df"], stats[None]["total"]
        df = np.array([stats[t]["df"] if t in stats else 0 for t in vocabulary.view(np.int64).tolist()], np.int64)
        weights = np.where(df > 0, term_weight(n_docs, df), 0)
        asked = [(r["item"], r["item_id"], np.searchsorted(vocabulary, h)) for r, h in zip(rows, hashes)]
        found = found.unionByName(index.groupBy("shard").applyInArrow(_search(asked, vocabulary, weights, n_docs, total, rules), FOUND_DDL))
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= rules.k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS.format("coalesce(text, '')")} AS terms FROM documents),
p AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(terms) AS term FROM d) GROUP BY ALL),
g AS (SELECT count(*)::BIGINT AS n, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
w AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, g GROUP BY term, n),
i AS (SELECT item, item_id, term FROM (SELECT item, item_id, unnest(list_distinct(terms)) AS term FROM
  (SELECT row_number() OVER () AS item, item_id, {_TERMS.format("coalesce(text, '')")} AS terms FROM benchmark))),
s AS (
  SELECT item, item_id, k, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf::BIGINT) // (1000 * tf + 8 * (100 - 90 + (90 * len(terms)::BIGINT * n) // total))))::BIGINT AS score
  FROM i JOIN p USING (term) JOIN w USING (term) JOIN d USING (k), g GROUP BY item, item_id, k),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
