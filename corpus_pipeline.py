"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

1. toxicity: documents whose matched clauses score 0.3 or more go (operator 5).
2. near duplicates: of documents that n-gram Jaccard links connect, one row with the smallest id
   stays, also of exact repeats (operator 7).
3. repeated passages: words in 50-word windows of smaller documents go; documents without any words
   left go (operator 10).
4. mixing: documents are repeated or left out so that sources meet their targets (operator 2).
5. tokens: texts become SentencePiece ids (operator 4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import jaccard, mixing, pieces, substrings, toxicity
from eventlake.llm.common import new_dir, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is not toxic, each judged by its own text; patterns are learned from ``labels``.

    Null and empty texts stay; rows that share an id are judged one by one; further columns stay as they are.
    """
    return toxicity.keep_civil(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near or exact copies: that with the smallest id, where a null id is the smallest.

    Of rows that share that id, one stays. Rows without words all stay; another text under the id of a copy stays.
    """
    return jaccard.keep_one(docs, repeats=False)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words in 50-word windows that a smaller id has too; rows without any words left go.

    A null id is larger than all others; null texts and texts without words stay; ``n_chars`` follows the text.
    """
    return substrings.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources takes them, at most three times each, by a hash of id and text.

    A null source is a source; rows without words are not taken; rows that are equal share their fate.
    """
    return mixing.apply_mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``token_ids`` and ``n_tokens`` of each row in place of its text; a null text has no tokens."""
    coded = pieces.encode(docs, pieces.tables_of())
    return coded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", drop_repeats),
    ("mixing", mix_sources),
    ("tokens", tokenise),
]

#: Hashes, learned patterns and the tokenizer have no SQL form; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_dir(spark, f"pipeline-{name.replace(' ', '_')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
