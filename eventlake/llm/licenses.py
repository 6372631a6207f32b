"""Operator 11: license scans by an exact set-similarity join of text blocks and templates.

Words are numbered; blocks are runs of consecutive words that overlap by half, in three widths, and each template
belongs to the smallest width of at least twice its words. A block matches a template if it holds at least ``share`` of
the template's different words. All such pairs are found, and only they:

1. words of templates are counted over all documents and ordered by that count, the rarest first;
2. one scan keeps the words of templates that blocks hold, for blocks with a word of a template's prefix (its
   ``size - needed + 1`` rarest words, one of which every match must hold) and at least as many words as the least
   template needs;
3. blocks meet templates in a join on the prefix words; pairs go where the block is too short (length filter), or
   where too few words follow the shared one in either order (positional filter);
4. what is left is verified by counting common words. Of the templates of a block, those whose words are all in
   another matched template give way to it (a GNU license's notice is in that of its lesser version).

Templates are a parameter with a bounded number of words, which makes them and their prefixes broadcasts of bounded
size. Phrases (words that stand consecutively) are found in the same scan.

Defined results:
* a null text has no words; a text without words has no labels and score 0;
* labels are those of phrases and of templates, distinct and sorted; the score is 1 if a phrase was found, else the
  largest share of a template's words in one block that matches it, else 0;
* rows are judged one by one, whatever their ids; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import text as tx
from eventlake.llm.common import cut, small, table

# Phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Notices as licenses word them, and their labels.
TEMPLATES = (
    ("mit", "released under the MIT license"),
    ("mit", "licensed under the MIT license"),
    ("mit", "this project is licensed under the terms of the MIT license"),
    (
        "mit",
        "permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the software), "
        "to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the software, and to permit persons to whom the software is furnished to do so",
    ),
    ("apache-2", "licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org"),
    ("bsd", "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    (
        "isc",
        "permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies",
    ),
    ("gpl-2", "this work is licensed under the GNU General Public License, version 2"),
    ("gpl-3", "this work is licensed under the GNU General Public License, version 3"),
    ("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("epl-2", "made available under the terms of the Eclipse Public License 2.0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "dedicated to the public domain under CC0 1.0 universal"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("all-rights-reserved", "all rights reserved"),
)


@dataclass(frozen=True)
class Scan:
    phrases: tuple[tuple[str, str], ...] = PHRASES
    #: (label, text) of templates.
    templates: tuple[tuple[str, str], ...] = TEMPLATES
    #: Share of a template's different words that a block must hold, in percent: short templates must be whole, as one word tells licenses apart.
    percent: int = 95
    #: Words of blocks; a template belongs to the first with room for its words twice, or to the last.
    widths: tuple[int, ...] = (16, 64, 256)
    #: Words of all templates, at most.
    most_words: int = 1_000_000


def words_of(text: str) -> list[str]:
    raw = np.frombuffer(text.encode(), np.uint8)
    words = tx.split_terms(raw, np.array([0, len(raw)]))
    return [words.data[a:b].tobytes().decode() for a, b in zip(words.start, words.end)]


def _hash(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words]).astype(np.int64)
    return tx.Spans.of(data).hash(np.r_[0, ends[:-1]].astype(np.int64), ends)


@dataclass
class Template:
    label: str
    words: list[str]  # different ones
    width: int
    needed: int


def templates_of(rules: Scan) -> list[Template]:
    out = []
    for label, text in rules.templates:
        words = words_of(text)
        unique = list(dict.fromkeys(words))
        if unique:
            width = next((w for w in rules.widths if w >= 2 * len(words)), rules.widths[-1])
            out.append(Template(label, unique, width, -(-len(unique) * rules.percent // 100)))
    if sum(len(t.words) for t in out) > rules.most_words:
        raise ValueError(f"templates have more than {rules.most_words} words")
    return out


# -- scans --------------------------------------------------------------------------------------

#: Bytes of text that are looked at together: a worker holds some hundred bytes for each.
SLICE_BYTES = 1 << 19


def _numbers(h: np.ndarray, sorted_hashes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The number of each word by its hash, or -1."""
    if not len(sorted_hashes):
        return np.full(len(h), -1, np.int64)
    at = np.searchsorted(sorted_hashes, h).clip(max=len(sorted_hashes) - 1)
    return np.where(sorted_hashes[at] == h, numbers[at], -1)


def word_counts(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """How often each word of the templates occurs in all documents."""
    hashes = _hash(vocabulary) if vocabulary else np.zeros(0, np.uint64)
    order = np.argsort(hashes)
    lookup = docs.sparkSession.sparkContext.broadcast((hashes[order], order))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for _, _, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                found = _numbers(tx.split_terms(data, offsets).hashes(), *lookup.value)
                total += np.bincount(found[found >= 0], minlength=len(vocabulary))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["word", "n"])

    found = docs.select("text").mapInArrow(work, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {vocabulary[r["word"]]: r["n"] for r in found.collect()}  # words of templates only


BLOCK = pa.struct([("width", pa.int32()), ("at", pa.int64()), ("words", pa.list_(pa.int32()))])
SCANNED = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.list_(pa.string())), ("blocks", pa.list_(BLOCK)),
])
SCANNED_DDL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, blocks array<struct<width: int, at: long, words: array<int>>>"
)


def _places(hashes: np.ndarray, owner: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """First words of the places where the words of a phrase stand in a row inside one text."""
    n = len(hashes) - len(phrase) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(hashes[:n] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[hashes[at + k] == phrase[k]]
    return at[owner[at] == owner[at + len(phrase) - 1]]


def _candidate_blocks(word: np.ndarray, at: np.ndarray, first: np.ndarray, owner: np.ndarray, width: int, prefix: np.ndarray, least: int) -> list[tuple]:
    """(text, first word in its text, words rarest first) of blocks with a prefix word and at least ``least`` words.

    ``word`` are the numbers of template words in order of rarity, ``at`` where they stand, in rising order.
    """
    step = width // 2
    # Blocks of a text begin at multiples of a step; a place is in the block that begins there, and the one before.
    own = owner[at]
    place = (at - first[own]) // step
    wanted = np.unique(np.concatenate([np.column_stack([own, place - back])[prefix[word]] for back in (0, 1)]), axis=0)
    wanted = wanted[wanted[:, 1] >= 0]
    out = []
    for text, block in wanted.tolist():
        begin = first[text] + block * step
        a, b = np.searchsorted(at, [begin, min(begin + width, first[text + 1])])
        held = np.unique(word[a:b])
        if len(held) >= least:
            out.append((text, block * step, held))
    return out


def scan(docs: DataFrame, templates: list[Template], order: dict[str, int], rules: Scan) -> DataFrame:
    """One row per document: phrases, and blocks that may match, with template words by their place in ``order``."""
    words = sorted(order, key=order.__getitem__)
    hashes = _hash(words) if words else np.zeros(0, np.uint64)
    by_hash = np.argsort(hashes)
    kinds = []
    for width in sorted({t.width for t in templates}):
        group = [t for t in templates if t.width == width]
        member, prefix = np.zeros(len(words), bool), np.zeros(len(words), bool)
        for t in group:
            ranks = sorted(order[w] for w in t.words)
            member[ranks] = True
            prefix[ranks[: len(ranks) - t.needed + 1]] = True
        kinds.append((width, member, prefix, min(t.needed for t in group)))
    phrases = [(_hash(words_of(text)), label) for text, label in rules.phrases]
    shared = docs.sparkSession.sparkContext.broadcast((hashes[by_hash], by_hash, kinds))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sorted_hashes, numbers, kinds = shared.value
        for batch in batches:
            for lo, hi, data, offsets in tx.slices(batch.column("text"), SLICE_BYTES):
                found = tx.split_terms(data, offsets)
                n, first, owner, h = found.texts, found.first, found.owner(), found.hashes()
                base, low, high = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                labels: list[set] = [set() for _ in range(n)]
                for phrase, label in phrases:
                    at = _places(h, owner, phrase)
                    np.add.at(base, owner[at], 1)
                    np.minimum.at(low, owner[at], at - first[owner[at]])
                    np.maximum.at(high, owner[at], at - first[owner[at]])
                    for text in np.unique(owner[at]).tolist():
                        labels[text].add(label)
                blocks: list[list] = [[] for _ in range(n)]
                number = _numbers(h, sorted_hashes, numbers)
                for width, member, prefix, least in kinds:
                    at = np.flatnonzero(number >= 0)
                    at = at[member[number[at]]]
                    for text, begin, held in _candidate_blocks(number[at], at, first, owner, width, prefix, least) if len(at) else []:
                        blocks[text].append({"width": width, "at": begin, "words": held.tolist()})
                none = base == 0
                columns = [batch.column("doc_id").slice(lo, hi - lo), pa.array(found.counts.astype(np.int64)), pa.array(base)]
                columns += [pa.array(low, mask=none), pa.array(high, mask=none), pa.array([sorted(x) for x in labels], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(blocks, pa.list_(BLOCK))], schema=SCANNED)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, SCANNED_DDL)


# -- join ---------------------------------------------------------------------------------------


def join(blocks: DataFrame, templates: list[Template], order: dict[str, int]) -> DataFrame:
    """row, width, at, template, label, share: all pairs of blocks (row, width, at, words) and templates that match.

    Words are numbers by rarity, and rise in a block.
    """
    spark = blocks.sparkSession
    rows = []
    for number, t in enumerate(templates):
        ranks = sorted(order[w] for w in t.words)
        over = [n for n, other in enumerate(templates) if set(t.words) < set(other.words)]
        for i, word in enumerate(ranks[: len(ranks) - t.needed + 1]):
            rows.append((number, t.label, t.width, word, i, len(ranks), t.needed, ranks, over))
    sides = spark.createDataFrame(rows, "template int, label string, t_width int, word int, i int, size int, needed int, t_words array<int>, over array<int>")
    sides = small(sides, len(rows))  # bounded by Scan.most_words
    held = blocks.select("row", "width", "at", "words", F.posexplode("words").alias("j", "word"))
    length = F.size("words") >= F.col("needed")
    position = 1 + F.least(F.col("size") - F.col("i") - 1, F.size("words") - F.col("j") - 1) >= F.col("needed")
    pairs = held.join(sides, (held["word"] == sides["word"]) & (F.col("width") == F.col("t_width")) & length & position)
    common = F.size(F.array_intersect("words", "t_words"))
    found = pairs.where(common >= F.col("needed")).withColumn("share", common / F.col("size"))
    matched = found.groupBy("row", "width", "at").agg(F.collect_set(F.struct("template", "label", "share", "over")).alias("m"))  # at most the templates
    numbers = F.transform("m", lambda x: x["template"])
    stay = F.filter("m", lambda x: ~F.arrays_overlap(x["over"], numbers))
    return matched.select("row", "width", "at", F.explode(stay).alias("x")).select("row", "width", "at", "x.template", "x.label", "x.share")


def label_documents(docs: DataFrame, rules: Scan = Scan()) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of each document."""
    templates = templates_of(rules)
    vocabulary = sorted({w for t in templates for w in t.words})
    counts = word_counts(docs, vocabulary)
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    # Rows of a checkpoint keep their numbers.
    scanned = cut(scan(docs, templates, order, rules)).withColumn("row", F.monotonically_increasing_id())
    blocks = scanned.select("row", F.explode("blocks").alias("b")).select("row", "b.*")
    found = join(blocks, templates, order).groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    none = F.array().cast("array<string>")
    joined = scanned.join(found, "row", "left").withColumn("all", F.array_distinct(F.concat("base_labels", F.coalesce("more", none))))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.sort_array("all"), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_documents(table(spark, sf_dir, "documents"))


def _oracle(rules: Scan = Scan()) -> str:
    """Base phrases and templates by counting words of every block; no filters, no order of words."""
    templates = templates_of(rules)
    quote = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    over = lambda t: [n for n, o in enumerate(templates) if set(t.words) < set(o.words)]
    values = ", ".join(f"({n}, '{t.label}', {t.width}, {t.needed}, {len(t.words)}, {quote(t.words)}, {over(t)}::INT[])" for n, t in enumerate(templates))
    phrases = ", ".join(f"({quote(words_of(text))}, '{label}')" for text, label in rules.phrases)
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
w AS (SELECT k, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM d),
ph(p, label) AS (VALUES {phrases}),
b AS (SELECT w.k, w.pos, label FROM w JOIN ph ON word = p[1] JOIN d USING (k) WHERE list_slice(words, pos + 1, pos + len(p)) = p),
base AS (SELECT k, count(*) AS n, min(pos) AS lo, max(pos) AS hi, list(DISTINCT label) AS labels FROM b GROUP BY k),
t(template, label, width, needed, size, words, supers) AS (VALUES {values}),
tw AS (SELECT template, width, unnest(words) AS word FROM t),
h AS (SELECT DISTINCT k, template, width, word, pos // (width // 2) - back AS block FROM w JOIN tw USING (word), (SELECT unnest([0, 1]) AS back)),
c AS (SELECT k, width, block, template, count(*) AS common FROM h WHERE block >= 0 GROUP BY ALL),
m AS (SELECT c.*, label, size, supers FROM c JOIN t USING (template) WHERE common >= needed),
s AS (SELECT *, list(template) OVER (PARTITION BY k, width, block) AS beside FROM m),
f AS (SELECT k, list(DISTINCT label) AS labels, max(common::DOUBLE / size) AS share FROM s WHERE NOT list_has_any(supers, beside) GROUP BY k)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(f.labels, [])))), ','), '') AS labels,
  CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (k) LEFT JOIN f USING (k)"""


ORACLE = _oracle()
