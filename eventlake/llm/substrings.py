"""Operator 10: removing repeated passages with suffix automata of reference shards.

A window is ``length`` consecutive words of one document. Each word that lies in a window which also
occurs in a document with a smaller id is removed. Comparing all windows of a corpus would shuffle a
row per word, so work is narrowed in steps that lose no window:

1. Anchors. Every window has an anchor, the least hash of its ``gram``-word runs. Equal windows have
   equal anchors, so windows are compared only within an anchor. Neighbouring windows of a document
   mostly share their anchor; such a run of at most ``run`` windows is a *segment* (about one for 20 words).
2. Equal segments are settled by their smallest document alone: a shuffle of (anchor, segment) keys
   with map-side minima, in which a passage copied a million times is one row per task.
3. Different segments with one anchor share some windows, not all. They are the reference: dealt to
   shards by anchor, a generalised suffix automaton is built over the segments of an anchor in the
   order of document ids, and each segment is first streamed through the automaton of the segments
   of smaller documents. Its matching statistics (the longest suffix seen before, at each word) mark
   every window with at least ``length`` matched words.
4. Anchors with more than ``block`` different segments (a licence line with different text around it) would
   make unbounded groups. Their segments are bundled instead; a bundle sends each of its distinct windows once,
   as hash and least document, to the window's bucket, and gets the least document of all bundles back. That
   is linear, and a window of a million documents is one entry of a bundle.
5. Documents are read again together with their own short list of first segments, and the words in
   removed windows are dropped.

Automata go to where their shard's segments are shuffled instead of being broadcast: the reference
is the corpus itself, so no bound on its size could be proven, and a shard's segments are the only
ones that can match it (the README has figures of broadcasting them in rounds).

Defined results:
* a null text has no words; documents shorter than a window keep all words;
* documents with equal ids are one another's equals: neither is the smaller one;
* a null id counts as larger than all others; rows with a null or repeated id are told apart by their text;
* an empty table gives an empty result; further columns are kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import text as tx
from eventlake.llm.common import cut, parallelism, small, table

_NO_ID = (1 << 63) - 1
#: Bytes of text that are looked at together, so that a worker stays small.
SLICE_BYTES = 1 << 19


@dataclass(frozen=True)
class Repeats:
    length: int = 50
    gram: int = 10
    #: Windows of a segment, at most.
    run: int = 256
    #: Different segments of one anchor that meet in an automaton, at most.
    block: int = 128
    #: Segments of a task that builds automata, and of a call in it, on average.
    task_segments: int = 4096
    shard_segments: int = 512
    #: Words of the segments of hot anchors by bucket of their windows, on average.
    bucket_words: int = 1 << 20


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


@dataclass
class Segments:
    """Runs of windows with one anchor: keys, owning text, first word and number of windows."""

    anchor: np.ndarray
    key: np.ndarray
    owner: np.ndarray
    first: np.ndarray
    windows: np.ndarray


def segments(words: tx.Words, hashes: np.ndarray, rules: Repeats) -> Segments:
    owner = words.owner()
    n = len(hashes)
    if n < rules.length:
        none = np.zeros(0, np.int64)
        return Segments(none.astype(np.uint64), none.astype(np.uint64), none, none, none)
    power, inverse = tx._power_tables(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * power[:n], out=prefix[1:])
    gram = tx.mix64((prefix[rules.gram :] - prefix[: n + 1 - rules.gram]) * inverse[: n + 1 - rules.gram])
    least = _sliding_min(gram, rules.length - rules.gram + 1)
    start = np.arange(len(least))
    whole = owner[start] == owner[start + rules.length - 1]
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (least[1:] != least[:-1]) | (owner[start[1:]] != owner[start[:-1]])
    begun = np.maximum.accumulate(np.where(new, start, 0))
    new |= whole & ((start - begun) % rules.run == 0)
    first = np.flatnonzero(new)
    total = np.cumsum(whole)
    count = np.diff(np.append(total[first] - 1, total[-1])) if len(first) else first
    last = first + count + rules.length - 1
    key = tx.mix64((prefix[last] - prefix[first]) * inverse[first] + count.astype(np.uint64))
    return Segments(least[first], key, owner[first], first, count)


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def _segment_rows(rules: Repeats):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, row = _ids(batch.column("doc_id")), batch.column("row").to_numpy()
            for lo, hi, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                words = tx.split_words(data, offsets)
                found = segments(words, words.hashes(), rules)
                doc, own = ids[lo:hi][found.owner], row[lo:hi][found.owner]
                same = tx.mix64(found.key + tx.mix64(doc.astype(np.uint64) + tx.mix64(own.astype(np.uint64))))
                _, once = np.unique(same, return_index=True)
                arrays = [tx.signed(found.anchor[once]), tx.signed(found.key[once]), doc[once], own[once]]
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], ["anchor", "seg", "doc", "row"])

    return work


CONTENT = "anchor long, seg long, doc long, row long, shard long, words binary"


def _wanted_words(rules: Repeats):
    """Word hashes of the wanted segments of each document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, row, wanted = _ids(batch.column("doc_id")), batch.column("row").to_numpy(), batch.column("segs")
            for lo, hi, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                words = tx.split_words(data, offsets)
                hashes = words.hashes()
                found = segments(words, hashes, rules)
                part = wanted.slice(lo, hi - lo)
                lists = part.value_lengths().to_numpy(zero_copy_only=False)
                inner = part.flatten()
                want = _in_text(np.repeat(np.arange(hi - lo), lists), inner.field("seg").to_numpy().view(np.uint64))
                order = np.argsort(want)
                want, shard = want[order], inner.field("shard").to_numpy(zero_copy_only=False)[order]
                mine = _in_text(found.owner, found.key)
                hit = np.flatnonzero(_member(mine, want))
                _, once = np.unique(mine[hit], return_index=True)
                hit = hit[once]
                content = [hashes[f : f + c + rules.length - 1].tobytes() for f, c in zip(found.first[hit], found.windows[hit])]
                of = found.owner[hit]
                arrays = [tx.signed(found.anchor[hit]), tx.signed(found.key[hit]), ids[lo:hi][of], row[lo:hi][of], shard[np.searchsorted(want, mine[hit])]]
                columns = [pa.array(a, pa.int64()) for a in arrays] + [pa.array(content, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, _names(CONTENT))

    return work


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


# -- windows of hot anchors ----------------------------------------------------------------------

BUNDLES = "segs binary, docs binary, rows binary, sizes binary, words binary"
POSTINGS = "bundle long, bucket int, windows binary, docs binary"
ANSWERS = "bundle long, bucket int, least binary"
GONE = "doc long, row long, seg long, gone array<int>"


def _bundle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments of a batch as one row."""
    for batch in batches:
        if batch.num_rows:
            content = batch.column("words").to_pylist()
            sizes = np.array([len(c) // 8 for c in content])
            packed = [*(batch.column(c).to_numpy().tobytes() for c in ("seg", "doc", "row")), sizes.tobytes(), b"".join(content)]
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in packed], _names(BUNDLES))


@dataclass
class Bundle:
    """Segments of a bundle: their ids, and their distinct windows by rising hash."""

    seg: np.ndarray
    doc: np.ndarray
    row: np.ndarray
    #: Of each window: its segment, its offset there, and its place among the distinct ones.
    owner: np.ndarray
    at: np.ndarray
    place: np.ndarray
    windows: np.ndarray

    @classmethod
    def of(cls, columns: dict, rules: Repeats) -> Bundle:
        seg, doc, row, sizes = (np.frombuffer(columns[c], np.int64) for c in ("segs", "docs", "rows", "sizes"))
        hashes = np.frombuffer(columns["words"], np.uint64)
        ends = np.append(0, np.cumsum(sizes))  # each segment is a text of its own
        found, first = tx.window_hashes(tx.Words(hashes, ends, ends, ends, ends), hashes, rules.length)
        owner = np.searchsorted(ends, first, side="right") - 1
        windows, place = np.unique(found, return_inverse=True)
        return cls(seg, doc, row, owner, first - ends[owner], place, windows)


def _posting_rows(bits: int, rules: Repeats):
    """The distinct windows of each bundle with their least document, by bucket."""
    bounds = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                b = Bundle.of(row, rules)
                least = np.full(len(b.windows), np.iinfo(np.int64).max)
                np.minimum.at(least, b.place, b.doc[b.owner])
                ends = np.array([0, *np.searchsorted(b.windows, bounds), len(b.windows)])
                some = np.flatnonzero(np.diff(ends))
                columns = [pa.array(np.full(len(some), row["bundle"])), pa.array(some.astype(np.int32))]
                columns += [pa.array([x[ends[k] : ends[k + 1]].tobytes() for k in some], pa.binary()) for x in (b.windows, least)]
                yield pa.RecordBatch.from_arrays(columns, _names(POSTINGS))

    return work


def _least_of_bucket(rows: pa.Table) -> pa.Table:
    """To each bundle, the least documents of its windows over all bundles."""
    got = rows.to_pydict()
    lists = [np.frombuffer(w, np.uint64) for w in got["windows"]]
    windows, place = np.unique(np.concatenate(lists), return_inverse=True)
    least = np.full(len(windows), np.iinfo(np.int64).max)
    np.minimum.at(least, place, np.concatenate([np.frombuffer(d, np.int64) for d in got["docs"]]))
    back = [least[p].tobytes() for p in np.split(place, np.cumsum([len(x) for x in lists])[:-1])]
    return pa.Table.from_arrays([pa.array(got["bundle"]), pa.array(got["bucket"], pa.int32()), pa.array(back, pa.binary())], _names(ANSWERS))


def _gone_of_bundle(rules: Repeats):
    """The windows of each segment that occur in a smaller document."""

    def work(bundle: pa.Table, answers: pa.Table) -> pa.Table:
        b = Bundle.of(bundle.to_pylist()[0], rules)
        least = np.frombuffer(b"".join(answers.sort_by("bucket").column("least").to_pylist()), np.int64)
        gone = np.flatnonzero(least[b.place] < b.doc[b.owner])
        of, first = np.unique(b.owner[gone], return_index=True)
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(gone)).astype(np.int32)), pa.array(b.at[gone].astype(np.int32)))
        return pa.Table.from_arrays([pa.array(b.doc[of]), pa.array(b.row[of]), pa.array(b.seg[of]), lists], _names(GONE))

    return work


def _settle_windows(content: DataFrame, rules: Repeats) -> DataFrame:
    """(doc, row, seg, gone) of segments by the least document of each window."""
    bundles = cut(content.select("seg", "doc", "row", "words").mapInArrow(_bundle_rows, BUNDLES).withColumn("bundle", F.monotonically_increasing_id()))
    size = bundles.agg(F.sum(F.octet_length("words") / 8)).first()[0] or 0
    bits = max(parallelism(content.sparkSession) - 1, int(size) // rules.bucket_words).bit_length()
    answers = bundles.mapInArrow(_posting_rows(bits, rules), POSTINGS).groupBy("bucket").applyInArrow(_least_of_bucket, ANSWERS)
    return bundles.groupBy("bundle").cogroup(answers.groupBy("bundle")).applyInArrow(_gone_of_bundle(rules), GONE)


def _in_text(owner: np.ndarray, key: np.ndarray) -> np.ndarray:
    return tx.mix64(key + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


class SuffixAutomaton:
    """A generalised suffix automaton that grows word by word and streams matching statistics."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.len = [0]

    def add(self, words: list[int]) -> None:
        nxt, link, length = self.next, self.link, self.len
        last = 0
        for w in words:
            seen = nxt[last].get(w)
            if seen is not None:
                if length[seen] == length[last] + 1:
                    last = seen
                    continue
                clone = len(nxt)
                nxt.append(nxt[seen].copy())
                link.append(link[seen])
                length.append(length[last] + 1)
                link[seen] = clone
                p = last
                while p >= 0 and nxt[p].get(w) == seen:
                    nxt[p][w] = clone
                    p = link[p]
                last = clone
                continue
            state = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and w not in nxt[p]:
                nxt[p][w] = state
                p = link[p]
            if p >= 0:
                q = nxt[p][w]
                if length[q] == length[p] + 1:
                    link[state] = q
                else:
                    clone = len(nxt)
                    nxt.append(nxt[q].copy())
                    link.append(link[q])
                    length.append(length[p] + 1)
                    link[q] = link[state] = clone
                    while p >= 0 and nxt[p].get(w) == q:
                        nxt[p][w] = clone
                        p = link[p]
            last = state

    def matched(self, words: list[int]) -> list[int]:
        """At each word, the length of the longest suffix up to it that was added before."""
        nxt, link, length = self.next, self.link, self.len
        state = run = 0
        out = []
        for w in words:
            to = nxt[state].get(w)
            while to is None and state:
                state = link[state]
                run = length[state]
                to = nxt[state].get(w)
            if to is None:
                run = 0
            else:
                state, run = to, run + 1
            out.append(run)
        return out


def _match_shard(rules: Repeats):
    """Stream the segments of each anchor, by rising document id, through the automaton of those before."""

    def work(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.drop_duplicates("seg").sort_values(["anchor", "doc", "seg"], kind="stable")
        out: list[tuple[int, int, int, list[int]]] = []
        for _, group in shard.groupby("anchor", sort=False):
            automaton = SuffixAutomaton()
            for doc, same in group.groupby("doc", sort=False):
                contents = [np.frombuffer(w, np.int64).tolist() for w in same["words"]]
                for seg, row, content in zip(same["seg"], same["row"], contents):
                    runs = np.array(automaton.matched(content))
                    hit = np.flatnonzero(runs[rules.length - 1 :] >= rules.length)
                    if len(hit):
                        out.append((doc, row, seg, hit.astype(np.int32)))
                for content in contents:
                    automaton.add(content)
        return pd.DataFrame(out, columns=["doc", "row", "seg", "gone"])

    return work


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(doc_id, text, row) of ``docs``, the null and repeated ids (as ``doc``), and how many those are.

    ``row`` is 0 where the id has one row, and else tells the rows of an id apart by their text.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = base.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    shared = cut(shared.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc")))
    n = shared.count()
    return _with_row(base, shared, n), shared, n


def _with_row(docs: DataFrame, shared: DataFrame, n: int) -> DataFrame:
    """``docs`` with their ``row``; doc_id is a long."""
    told = small(shared.select("doc", F.lit(True).alias("told")), n)
    marked = docs.join(told, F.coalesce("doc_id", F.lit(_NO_ID)) == F.col("doc"), "left").drop("doc")
    return marked.withColumn("row", F.when(F.col("told"), F.xxhash64("text").bitwiseOR(F.lit(1))).otherwise(0)).drop("told")


def _first_lists(base: DataFrame, shared: DataFrame, n_shared: int, rules: Repeats) -> DataFrame:
    """(doc, row, firsts): the segments whose smallest document is ``doc``, with their removed windows.

    ``firsts`` holds (seg, gone); ``gone`` lists the offsets of windows found in a smaller document.
    Segments of a document that are not listed occur whole in a smaller document.
    """
    rows = base.mapInArrow(_segment_rows(rules), "anchor long, seg long, doc long, row long")
    firsts = cut(rows.groupBy("anchor", "seg").agg(F.min("doc").alias("doc")))
    # Ids with one row have their segments as they are; of the others, each row has its own.
    single = firsts.join(small(shared, n_shared), "doc", "left_anti").withColumn("row", F.lit(0).cast("long"))
    many = base.where("row <> 0").mapInArrow(_segment_rows(rules), "anchor long, seg long, doc long, row long")
    several = cut(many.join(firsts, ["anchor", "seg", "doc"]).select("anchor", "seg", "doc", "row").distinct())
    one = single.select("anchor", "seg", "doc", "row").unionByName(several.groupBy("anchor", "seg", "doc").agg(F.min("row").alias("row")))
    by_anchor = firsts.groupBy("anchor").agg(F.count("*").alias("n"), F.min("doc").alias("least"), F.max("doc").alias("most"))
    mixed = cut(by_anchor.where("n > 1 AND least < most").select("anchor", "n"))
    hot = mixed.where(F.col("n") > rules.block).select("anchor")
    cold = mixed.where(F.col("n") <= rules.block)
    counted = mixed.agg(F.count_if(F.col("n") > rules.block), F.sum(F.when(F.col("n") <= rules.block, F.col("n")))).first()
    n_hot, n_cold = counted[0], counted[1] or 0
    parallel = parallelism(base.sparkSession)
    # Hot anchors are looked up apart, so that no task gets all segments of one; their shard is -1.
    shards = max(parallel, -(-n_cold // rules.shard_segments))
    in_hot = one.join(small(hot, n_hot), "anchor").select("doc", "row", "seg", F.lit(-1).cast("long").alias("shard"))
    in_cold = one.join(small(hot, n_hot), "anchor", "left_anti").join(cold, "anchor")
    in_cold = in_cold.select("doc", "row", "seg", F.pmod(F.col("anchor"), F.lit(shards)).alias("shard"))
    wanted = in_hot.unionByName(in_cold).groupBy("doc", "row").agg(F.collect_list(F.struct("seg", "shard")).alias("segs"))
    wanted = cut(wanted)
    listed = wanted.agg(F.sum(F.size("segs"))).first()[0] or 0  # lists are long for long texts, so segments are counted
    keyed = base.withColumn("doc_id", F.coalesce("doc_id", F.lit(_NO_ID)))
    lists = small(wanted.withColumnRenamed("row", "of"), listed)
    with_segs = keyed.join(lists, (F.col("doc_id") == F.col("doc")) & (F.col("row") == F.col("of"))).select("doc_id", "row", "text", "segs")
    content = cut(with_segs.mapInArrow(_wanted_words(rules), CONTENT))
    met = content.where("shard >= 0").repartition(max(parallel, -(-n_cold // rules.task_segments)), "shard")
    partly = met.groupBy("shard").applyInPandas(_match_shard(rules), GONE)
    partly = partly.unionByName(_settle_windows(content.where("shard < 0"), rules))
    partly = cut(partly)
    others = partly.where("row <> 0").drop("row").join(several.select("doc", "row", "seg"), ["doc", "seg"])
    none = F.array().cast("array<int>")
    listed = single.select("doc", "row", "seg", none.alias("gone")).unionByName(several.select("doc", "row", "seg", none.alias("gone")))
    listed = listed.unionByName(partly.where("row = 0")).unionByName(others.select("doc", "row", "seg", "gone"))
    return listed.groupBy("doc", "row").agg(F.collect_list(F.struct("seg", "gone")).alias("firsts"))


def removed_words(words: tx.Words, hashes: np.ndarray, firsts: pa.Array, rules: Repeats) -> np.ndarray:
    """A flag for each word of a slice; ``firsts`` is the list column of :func:`first_segments`."""
    found = segments(words, hashes, rules)
    lists = firsts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    inner = firsts.flatten()
    seg = inner.field("seg").to_numpy(zero_copy_only=False).view(np.uint64)
    gone = inner.field("gone")
    owner = np.repeat(np.arange(words.texts), lists)
    key = _in_text(owner, seg)
    mine = _in_text(found.owner, found.key)
    whole = ~_member(mine, np.sort(key))
    change = np.zeros(len(hashes) + rules.length + 1, np.int64)
    start, count = found.first[whole], found.windows[whole]
    np.add.at(change, start, 1)
    np.add.at(change, start + count + rules.length - 1, -1)
    sizes = gone.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    some = sizes > 0
    if some.any():
        values = gone.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        order = np.argsort(mine)
        ordered = mine[order]
        for j in np.flatnonzero(some):
            lo, hi = np.searchsorted(ordered, key[j]), np.searchsorted(ordered, key[j], side="right")
            at = found.first[order[lo:hi]][:, None] + values[ends[j] - sizes[j] : ends[j]][None, :]
            np.add.at(change, at.ravel(), 1)
            np.add.at(change, at.ravel() + rules.length, -1)
    return np.cumsum(change)[: len(hashes)] > 0


def _kept_bytes(words: tx.Words, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept words of each text joined by one space: bytes and offsets."""
    n = len(words.data)
    kept = ~gone
    start, end, owner = words.start[kept], words.end[kept], words.owner()[kept]
    change = np.zeros(n + 2, np.int8)
    change[start] += 1
    np.subtract.at(change, end, 1)
    inside = np.cumsum(change[:n]) > 0
    data = words.data.copy()
    follows = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else owner
    gap = end[follows]
    data[gap] = 0x20
    inside[gap] = True
    run = np.zeros(n + 1, np.int64)
    np.cumsum(inside, out=run[1:])
    return data[inside], run[words.offsets]


def _with_firsts(docs: DataFrame, rules: Repeats) -> DataFrame:
    """All columns of ``docs`` as ``whole``, its text, and ``firsts``."""
    base, shared, n = _keyed(docs)
    listed = cut(_first_lists(base, shared, n, rules)).withColumnRenamed("row", "of")
    whole = docs.select(F.struct("*").alias("whole"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = _with_row(whole, shared, n)
    same = (F.coalesce("doc_id", F.lit(_NO_ID)) == F.col("doc")) & (F.col("row") == F.col("of"))
    return keyed.join(listed, same, "left").select("whole", "doc_id", "text", "firsts")


DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def digests(docs: DataFrame, rules: Repeats = Repeats()) -> DataFrame:
    """One row per document: words, removed words, and the SHA-256 of what is kept."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                words = tx.split_words(data, offsets)
                gone = removed_words(words, words.hashes(), batch.column("firsts").slice(lo, hi - lo), rules)
                kept, at = _kept_bytes(words, gone)
                view = memoryview(kept)
                sums = [hashlib.sha256(view[at[i] : at[i + 1]]).hexdigest() for i in range(hi - lo)]
                removed = np.bincount(words.owner()[gone], minlength=hi - lo)
                columns = [batch.column("doc_id").slice(lo, hi - lo), pa.array(words.counts, pa.int64())]
                columns += [pa.array(removed, pa.int64()), pa.array(sums, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    base = docs.select("doc_id", "text")
    return _with_firsts(base, rules).select("doc_id", "text", "firsts").mapInArrow(work, DIGEST)


def remove_repeats(docs: DataFrame, rules: Repeats = Repeats()) -> DataFrame:
    """The rows of ``docs`` without repeated passages.

    A text that loses no word stays as it is; from others, removed words go together with the
    white space behind them. Documents that lose all their words are dropped.
    """
    names = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                words = tx.split_words(data, offsets)
                gone = removed_words(words, words.hashes(), batch.column("firsts").slice(lo, hi - lo), rules)
                removed = np.bincount(words.owner()[gone], minlength=hi - lo)
                # A removed word takes the bytes up to the next word or the end of its text.
                upto = np.append(words.start[1:], len(data)) if len(words.start) else words.start
                upto = np.minimum(upto, offsets[1:][words.owner()])
                change = np.zeros(len(data) + 1, np.int64)
                np.add.at(change, words.start[gone], 1)
                np.add.at(change, upto[gone], -1)
                stay = np.cumsum(change[:-1]) == 0
                run = np.zeros(len(data) + 1, np.int64)
                np.cumsum(stay, out=run[1:])
                kept = pa.Array.from_buffers(
                    pa.large_string(), hi - lo, [None, pa.py_buffer(np.ascontiguousarray(run[offsets])), pa.py_buffer(data[stay])]
                ).cast(pa.string())
                part = batch.slice(lo, hi - lo)
                text = pc.if_else(pa.array(removed == 0), part.column("text"), kept)
                columns = [text if name == "text" else x for name, x in zip(names, part.column("whole").flatten())]
                left = pa.array((removed == 0) | (removed < words.counts))
                yield pa.RecordBatch.from_arrays(columns, names).filter(left)

    return _with_firsts(docs, rules).select("whole", "text", "firsts").mapInArrow(work, docs.schema)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^ \t-\r]+'), []) AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM i),
m AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS least FROM h),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM m WHERE least < doc_id),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
      FROM t ANTI JOIN g ON t.doc_id = g.doc_id AND t.p = g.p GROUP BY t.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
