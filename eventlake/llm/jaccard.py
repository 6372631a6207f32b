"""Operator 7: n-gram Jaccard join with a MinHash LSH forest and exact verification.

Two documents are linked if the Jaccard similarity of their sets of five-word shingles is at least
the threshold (0.8). The result has one row per document: its class (documents that links connect;
named by the smallest id) and its number of links.

* Documents with equal shingle sets are copies. They are collapsed to one node with map-side sums
  before anything is compared, so a group of a million copies costs a row per task.
* Each node gets a signature of ``trees x depth`` minimum hashes. A tree sorts nodes by their label, the
  ``depth`` values of that tree; nodes with a common prefix are a node of its trie.
* Matches start at the full depth. Pairs below the deepest trie nodes are verified first; from the
  similarities found, each node's recall so far is estimated (a link of similarity ``s`` stands for
  ``1 / p(s)`` links, ``p`` being the chance to share a prefix of this length in some tree). Nodes below
  the target recall, and those without any link yet, shorten their prefixes by one value and so meet the
  other children of the trie node above; nodes that reached the target stop. No prefix gets shorter than
  ``prefix_length``, where a pair at the threshold itself has the target recall (with 24 trees a miss
  probability below 1e-5). Large groups of close copies so stop at their deepest prefixes.
* Trie nodes with the same members in several trees are kept once, and a pair counts only at its longest
  common prefix, in the first tree that has it.
* Trie nodes with more than ``block`` members, or more than ``block_bytes`` of shingles, are dealt to blocks
  by hash, and every pair of blocks is a cell with a task of its own. In a cell, intersections come from a
  product of incidence matrices, so all pairs are verified exactly while only one row per node leaves the
  cell: its links, its evidence, and the smallest node that the cell's links connect it with.
* Classes are the connected components of those (node, smallest node) rows, found by label
  propagation with pointer jumping, with a checkpoint for each round.

Defined results:
* a text with one to four words has one shingle, all its words; null texts and texts without words
  have none, are linked to nothing and form classes of their own;
* a document's links count documents, so the copies of a node count one each; the document itself
  does not count;
* repeated rows are copies of each other; an empty table gives an empty result; other columns are
  ignored by ``join`` and kept by ``keep_one``;
* a null id orders before all others; rows are told apart by id and text, so groups of rows with a null
  or shared id are like any others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from eventlake.llm import text as tx
from eventlake.llm.common import cut, parallelism, small, table

_NO_ID = -(1 << 63)
#: Bytes of text that are looked at together, so that a worker stays small.
SLICE_BYTES = 1 << 19


@dataclass(frozen=True)
class Forest:
    words: int = 5
    threshold: float = 0.8
    trees: int = 24
    depth: int = 6
    recall: float = 0.99999
    #: Nodes of one block of a cell, and bytes of their shingles, on average at most.
    block: int = 512
    block_bytes: int = 8 << 20
    #: Trie nodes of at most so many members are looked at pair by pair.
    small: int = 32
    #: Members of such trie nodes to a call, and ``block_bytes`` of their shingles, on average at most.
    shard_nodes: int = 512


def recall_at(rules: Forest, prefix: int) -> float:
    """Probability that a pair at the threshold shares a prefix of this length in some tree."""
    return 1.0 - (1.0 - rules.threshold**prefix) ** rules.trees


def prefix_length(rules: Forest) -> int:
    """The longest prefix with the target recall: shortened from the full depth, one value at a time."""
    prefix = rules.depth
    while prefix > 1 and recall_at(rules, prefix) < rules.recall:
        prefix -= 1
    return prefix


def shingles(words: tx.Words, rules: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, and the offsets of the texts among them."""
    hashes = words.hashes()
    found, first = tx.window_hashes(words, hashes, rules.words)
    owner = words.owner()[first]
    short = np.flatnonzero((words.counts > 0) & (words.counts < rules.words))
    if len(short):
        one = []
        for i in short:
            part = hashes[words.first[i] : words.first[i + 1]]
            one.append(tx.mix64(part * np.arange(3, 2 * len(part) + 3, 2, dtype=np.uint64)).sum(dtype=np.uint64))
        found, owner = np.append(found, np.array(one, np.uint64)), np.append(owner, short)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[new], owner[new]
    return found, np.searchsorted(owner, np.arange(words.texts + 1))


def _set_hash(found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64 bits for each shingle set."""
    total = np.zeros(len(found) + 1, np.uint64)
    np.cumsum(tx.mix64(found), out=total[1:])
    squares = np.zeros(len(found) + 1, np.uint64)
    np.cumsum(tx.mix64(found ^ np.uint64(0x5851F42D4C957F2D)), out=squares[1:])
    size = np.diff(at).astype(np.uint64)
    return tx.mix64((total[at[1:]] - total[at[:-1]]) ^ tx.mix64(squares[at[1:]] - squares[at[:-1]] + size))


def shares_prefix(rules: Forest, similarity: np.ndarray, prefix: int) -> np.ndarray:
    """Probability that pairs of these similarities share a prefix of this length in some tree."""
    return -np.expm1(rules.trees * np.log1p(-np.minimum(similarity**prefix, 1 - 1e-12)))


def labels(found: np.ndarray, at: np.ndarray, rules: Forest) -> np.ndarray:
    """16 mixed bits of the minimum hashes of each set, as texts x trees x depth."""
    seeds = tx.mix64(np.arange(1, rules.trees * rules.depth + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)
    least = np.zeros((len(at) - 1, len(seeds)), np.uint32)
    full = np.flatnonzero(np.diff(at) > 0)
    if len(full):
        for k, seed in enumerate(seeds):
            least[full, k] = np.minimum.reduceat((found * seed) >> np.uint64(32), at[full])
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16).reshape(-1, rules.trees, rules.depth)


def _node_rows(rules: Forest):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                found, at = shingles(tx.split_words(data, offsets), rules)
                label = [x.tobytes() for x in labels(found, at, rules)]
                size = np.diff(at)
                node = pa.array(tx.signed(_set_hash(found, at)), pa.int64(), mask=size == 0)
                ids = [batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "row")]
                columns = [*ids, node, pa.array(size, pa.int32()), pa.array(label, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "node", "size", "labels"])

    return work


def _set_rows(rules: Forest):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                found, at = shingles(tx.split_words(data, offsets), rules)
                node = tx.signed(_set_hash(found, at))
                sets = [found[at[i] : at[i + 1]].tobytes() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(sets, pa.binary())], ["node", "shingles"])

    return work


def _steps(rules: Forest) -> list[str]:
    """Columns of the values behind the shortest prefix, one for each depth."""
    return [f"q{d}" for d in range(prefix_length(rules) + 1, rules.depth + 1)]


def _trie_rows(rules: Forest):
    """Each node's place in each tree: its shortest prefix, and what tells longer ones apart."""
    shortest = prefix_length(rules)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            label = np.frombuffer(b"".join(batch.column("labels").to_pylist()), np.uint16).reshape(n, rules.trees, rules.depth)
            key = np.zeros((n, rules.trees), np.uint64)
            keys = []
            for d in range(rules.depth):
                key = tx.mix64(key * np.uint64(3) + label[:, :, d] + np.uint64(1))
                keys.append(key)
            columns = [np.repeat(batch.column(c).to_numpy(), rules.trees) for c in ("node", "size")]
            columns += [np.tile(np.arange(rules.trees, dtype=np.int32), n), tx.signed(keys[shortest - 1].ravel())]
            columns += [(k >> np.uint64(33)).astype(np.int32).ravel() for k in keys[shortest:]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "size", "tree", "prefix", *_steps(rules)])

    return work


def intersections(sets: list[np.ndarray], cells: int = 4_000_000) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, as a product of incidence matrices."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[column] > 1
    row, column = row[shared], column[shared]
    out = np.zeros((n, n), np.float32)
    if not len(row):
        return out
    column = np.unique(column, return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(1, cells // n)
    for at in range(0, int(column[-1]) + 1, width):
        lo, hi = np.searchsorted(column, at), np.searchsorted(column, at + width)
        part = np.zeros((n, min(width, int(column[-1]) + 1 - at)), np.float32)
        part[row[lo:hi], column[lo:hi] - at] = 1
        out += part @ part.T
    return out


@dataclass
class Cell:
    """Rows of a task's trie nodes as arrays."""

    node: np.ndarray
    copies: np.ndarray
    looks: np.ndarray
    side: np.ndarray
    tree: np.ndarray
    sets: list[np.ndarray]
    size: np.ndarray
    values: np.ndarray

    def longest_here(self, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
        """Whether the longest common prefix of pairs has this depth, and is in their row's tree first; one of the two looks."""
        out = self.looks[a] | self.looks[b]
        at = np.flatnonzero(out)
        trees = np.arange(self.values.shape[1])
        for lo in range(0, len(at), 20_000):
            part = at[lo : lo + 20_000]
            equal = self.values[a[part]] == self.values[b[part]]
            here = equal[:, :, :depth].all(axis=2)
            longer = here & equal[:, :, depth] if depth < equal.shape[2] else np.zeros_like(here)
            tree = self.tree[a[part]]
            out[part] = here[np.arange(len(part)), tree] & ~longer.any(axis=1) & ~(here & (trees < tree[:, None])).any(axis=1)
        return out

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of pairs of sorted sets."""
        return np.array([np.intersect1d(self.sets[i], self.sets[j], assume_unique=True).size for i, j in zip(a.tolist(), b.tolist())], np.float64)


def _linked_pairs(c: Cell, at: np.ndarray, depth: int, rules: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, similarity) of the linked pairs that count among the rows ``at`` of a large trie node."""
    both = intersections([c.sets[i] for i in at]).astype(np.float64)
    size = c.size[at]
    linked = both >= rules.threshold * (size[:, None] + size[None, :] - both) - 1e-9
    linked &= c.side[at][:, None] != c.side[at][None, :] if c.side[at[0]] >= 0 else True
    a, b = np.nonzero(np.triu(linked, 1))
    here = c.longest_here(at[a], at[b], depth)
    a, b = a[here], b[here]
    return at[a], at[b], both[a, b] / (size[a] + size[b] - both[a, b])


def _cells(rules: Forest, depth: int):
    """Verify the pairs of trie nodes: links and evidence of each node, and the smallest node it is connected with."""
    lower = range(depth, prefix_length(rules), -1)

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bucket", ignore_index=True, kind="stable")
        sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        between = rows["lo"].iat[0] != rows["hi"].iat[0]
        c = Cell(
            rows["node"].to_numpy(), rows["copies"].to_numpy().astype(np.float64), rows["looks"].to_numpy(),
            (rows["own"] == rows["lo"]).to_numpy().astype(np.int8) if between else np.full(len(rows), -1, np.int8),
            rows["tree"].to_numpy(), sets, np.array([len(s) for s in sets], np.float64),
            np.frombuffer(b"".join(rows["labels"]), np.uint16).reshape(-1, rules.trees, rules.depth),
        )
        bucket = rows["bucket"].to_numpy()
        starts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        found, few = [], []
        for lo, hi in zip(starts, starts[1:]):
            if hi - lo > rules.small:
                found.append(_linked_pairs(c, np.arange(lo, hi), depth, rules))
            else:
                few.append(lo + np.stack(np.triu_indices(hi - lo, 1)))
        if few:
            a, b = np.concatenate(few, axis=1)
            here = c.longest_here(a, b, depth)
            here &= (c.side[a] != c.side[b]) | (c.side[a] < 0)
            a, b = a[here], b[here]
            both = c.common(a, b)
            similarity = both / (c.size[a] + c.size[b] - both)
            linked = both >= rules.threshold * (c.size[a] + c.size[b] - both) - 1e-9
            found.append((a[linked], b[linked], similarity[linked]))
        a, b, similarity = (np.concatenate(x) for x in zip(*found))
        n = len(rows)
        label = np.arange(n)
        while True:  # labels sink to the smallest connected row
            low = label.copy()
            np.minimum.at(low, a, label[b])
            np.minimum.at(low, b, label[a])
            low = low[low]
            if (low == label).all():
                break
            label = low
        out = pd.DataFrame({"node": c.node, "low": c.node[label]})
        out["links"] = (np.bincount(a, c.copies[b], n) + np.bincount(b, c.copies[a], n)).astype(np.int64)
        out["pairs"] = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
        missed = [1 / shares_prefix(rules, similarity, d) - 1 for d in lower]
        out["missed"] = list(np.stack([np.bincount(a, m, n) + np.bincount(b, m, n) for m in missed], 1)) if missed else [[]] * n
        return out[out["pairs"] > 0]

    return work


def _settled(verified: DataFrame, depth: int, rules: Forest) -> DataFrame:
    """Nodes whose links found at this depth or deeper make up the target recall."""
    # ``missed`` begins at the depth where the pair was found.
    missed = F.element_at("missed", (F.col("depth") - depth + 1).cast("int"))
    sums = verified.groupBy("node").agg(F.sum("pairs").alias("pairs"), F.sum(missed).alias("missed"))
    return sums.where((F.col("pairs") > 0) & (F.col("missed") <= (1 - rules.recall) * (F.col("pairs") + F.col("missed")))).select("node")


def _shards(members: DataFrame, rules: Forest) -> int:
    """Calls that small trie nodes are dealt to: enough for the rows and for the bytes of any depth."""
    n, size = members.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    return max(parallelism(members.sparkSession), -(-n // rules.shard_nodes), -(-8 * size // rules.block_bytes))


def _verify(members: DataFrame, shards: int, known: DataFrame, depth: int, verified: DataFrame | None, rules: Forest) -> DataFrame:
    """The links of pairs whose longest common prefix has this depth; ``verified`` holds those of deeper ones."""
    steps = _steps(rules)
    prefix = ["tree", "prefix", *steps[: depth - prefix_length(rules)]]
    looks = members.withColumn("looks", F.lit(True))
    if verified is not None:
        settled = _settled(verified, depth + 1, rules).withColumn("looks", F.lit(False))
        looks = members.join(settled, "node", "left").withColumn("looks", F.coalesce("looks", F.lit(True)))
    mark = F.xxhash64("node")
    sums = [F.count("*").alias("n"), F.sum("size").alias("shingles"), F.sum(F.shiftrightunsigned(mark, 20)).alias("s"), F.bit_xor(mark).alias("x")]
    found = looks.groupBy(*prefix).agg(*sums, F.max("looks").alias("any"), *[F.min(c).alias(f"min_{c}") for c in steps], *[F.max(c).alias(f"max_{c}") for c in steps])
    found = found.where("n > 1 AND any")
    if depth < rules.depth:  # one child alone has only pairs with longer prefixes
        child = steps[depth - prefix_length(rules)]
        found = found.where(f"min_{child} <> max_{child}")
    kept = found.groupBy("n", "s", "x").agg(F.min(F.struct(*prefix)).alias("b"), F.max("shingles").alias("shingles"))
    kept = kept.select("b.*", "n", "shingles")
    # Small trie nodes share calls of tasks; a large one is cells of its own.
    bucket = F.xxhash64(*prefix)
    blocks = F.ceil(F.greatest(F.col("n") / rules.block, F.col("shingles") * 8 / rules.block_bytes)).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.struct(F.least(b, F.col("own")).alias("lo"), F.greatest(b, F.col("own")).alias("hi")))
    cells = (
        looks.join(kept, prefix)
        .withColumn("own", own)
        .withColumn("pair", F.explode(pairs))
        .withColumn("shard", F.when(F.col("n") > rules.small, bucket).otherwise(F.pmod(bucket, F.lit(shards))))
        .select("shard", "pair.lo", "pair.hi", bucket.alias("bucket"), "tree", "own", "node", "looks")
        .join(known, "node")
    )
    schema = "node long, low long, links long, pairs long, missed array<double>"
    return cut(cells.groupBy("shard", "lo", "hi").applyInPandas(_cells(rules, depth), schema).withColumn("depth", F.lit(depth)))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` (node, low) is connected with.

    Each round, a node takes the smallest label of its neighbours and then its label's label; rounds
    grow with the logarithm of the longest path. Labels only sink, so an unchanged sum ends the loop.
    """
    both = edges.select("node", F.col("low").alias("other")).where("node <> other")
    both = cut(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct())
    label = cut(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")))
    total = F.sum(F.col("label").cast("decimal(38,0)"))
    before = label.agg(total).first()[0]
    while before is not None:
        seen = both.join(label.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        sunk = label.join(seen, "node", "left").select("node", F.least("label", "near").alias("label"))
        of = sunk.select(F.col("node").alias("label"), F.col("label").alias("lower"))
        label = cut(sunk.join(of, "label", "left").select("node", F.least("label", "lower").alias("label")))
        now = label.agg(total).first()[0]
        if now == before:
            break
        before = now
    return label


def _labelled(docs: DataFrame, rules: Forest = Forest()) -> DataFrame:
    """Rows of ``classes`` with the label of their component."""
    # A row is told by its id and text; rows that share both have one node.
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row", F.xxhash64("doc_id", "text"))
    signed = cut(base.mapInArrow(_node_rows(rules), "doc_id long, row long, node long, size int, labels binary"))
    rows = signed.select("doc_id", "node")
    some = signed.where("node IS NOT NULL").withColumn("key", F.coalesce("doc_id", F.lit(_NO_ID)))
    nodes = cut(
        some.groupBy("node").agg(
            F.min("key").alias("key"), F.count("*").alias("copies"), F.min("row").alias("row"), F.first("size").alias("size"), F.first("labels").alias("labels")
        )
    )
    steps = _steps(rules)
    trie = nodes.select("node", "size", "labels").mapInArrow(
        _trie_rows(rules), ", ".join(["node long, size int, tree int, prefix long", *(f"{c} int" for c in steps)])
    )
    shared = trie.groupBy("tree", "prefix").agg(F.count("*").alias("n")).where("n > 1").select("tree", "prefix")
    members = cut(trie.join(shared, ["tree", "prefix"]))
    # Shingle sets of the nodes that share a prefix with another, from the row that stands for each.
    wanted = cut(members.select("node").distinct().join(nodes, "node").select("node", "row", "copies", "labels"))
    texts = base.join(small(wanted.select("row"), wanted.count()), "row", "left_semi")
    sets = texts.select("text").mapInArrow(_set_rows(rules), "node long, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))
    known = cut(wanted.select("node", "copies", "labels").join(sets, "node"))
    shards = _shards(members, rules)
    verified = None
    for depth in range(rules.depth, prefix_length(rules) - 1, -1):
        found = _verify(members, shards, known, depth, verified, rules)
        verified = found if verified is None else verified.unionByName(found)
    label = components(verified)
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("key").alias("class_key"))
    facts = named.join(least, "label").join(links, "node", "left").select(
        "node", "key", "label", "class_key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    # Nodes without links need no row: their document is its own class.
    facts = cut(facts.where("n_links > 0 OR class_key <> key").select("node", "label", "class_key", "n_links"))
    found = rows.select("doc_id", "node").join(small(facts, facts.count()), "node", "left")
    own_class = F.coalesce(F.col("class_key"), F.col("doc_id"))
    return found.select(
        "doc_id",
        "node",
        F.when(own_class != _NO_ID, own_class).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("label", "node").alias("label"),
    )


def classes(docs: DataFrame, rules: Forest = Forest()) -> DataFrame:
    """One row per row of ``docs``: doc_id, node (its shingle set), class_id and n_links."""
    return _labelled(docs, rules).drop("label")


def _coded(docs: DataFrame, rules: Forest) -> DataFrame:
    """Rows of ``docs`` whole, with their ids and nodes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                found, at = shingles(tx.split_words(data, offsets), rules)
                node = pa.array(tx.signed(_set_hash(found, at)), pa.int64(), mask=np.diff(at) == 0)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("id"), node], ["row", "id", "node"])

    schema = StructType([StructField("row", docs.schema), StructField("id", LongType()), StructField("node", LongType())])
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(work, schema)


def keep_one(docs: DataFrame, rules: Forest = Forest(), repeats: bool = True) -> DataFrame:
    """The document with the smallest id of each class.

    With ``repeats``, rows that repeat its id all stay; without, one row of a class stays: of rows that share the smallest
    id, that with the least shingle set and text (and any of those that differ in other columns only).

    A null id is the smallest; of a class with several rows without id, one such row stays. Rows without
    words all stay. Rows are judged by id and text, so another text under the id of a copy stays.
    """
    marked = cut(_labelled(docs, rules).where("node IS NOT NULL"))
    gone = marked.where(F.col("doc_id") != F.coalesce("class_id", F.lit(_NO_ID)))
    gone = cut(gone.select(F.col("doc_id").alias("id"), "node").distinct())
    named = _coded(docs.where(F.col("doc_id").cast("long").isNotNull()), rules).join(small(gone, gone.count()), ["id", "node"], "left_anti")
    nameless = _coded(docs.where(F.col("doc_id").cast("long").isNull()), rules)
    label = cut(marked.where("doc_id IS NULL").select("node", "label").distinct())
    first = nameless.join(small(label, label.count()), "node").dropDuplicates(["label"])
    if not repeats:
        # Only rows that share id and class are shuffled; equal ones are joined before that.
        shared = marked.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"), "label").agg(F.count("*").alias("n"), F.collect_set("node").alias("nodes"))
        shared = cut(shared.where("n > 1").select("id", "label", F.explode("nodes").alias("node")))
        several = small(shared, shared.count())
        one = named.join(several, ["id", "node"]).groupBy("id", "label").agg(F.min_by("row", F.struct("node", F.xxhash64("row.text"))).alias("row"))
        named = named.join(several, ["id", "node"], "left_anti").select("row").unionByName(one.select("row"))
    rows = named.select("row").unionByName(first.select("row")).unionByName(nameless.where("node IS NULL").select("row"))
    return rows.select("row.*")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


ORACLE = r"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^ \t-\r]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n AS x ON x.r = a JOIN n AS y ON y.r = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
reach AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT reach.a AS r, min(d.doc_id) AS least FROM reach JOIN d ON d.r = reach.b GROUP BY reach.a),
k AS (SELECT a AS r, count(*) AS n FROM l GROUP BY a)
SELECT d.doc_id, least(d.doc_id, coalesce(c.least, d.doc_id))::BIGINT AS class_id, coalesce(k.n, 0)::BIGINT AS n_links
FROM d LEFT JOIN c ON c.r = d.r LEFT JOIN k ON k.r = d.r
"""
