"""Checks of search texts before they are run in time chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed word lists of the search language.
TIME_MODIFIERS = (
    "_index_earliest _index_latest earliest latest starttimeu endtimeu starttime endtime searchtimespanhours "
    "searchtimespanminutes searchtimespandays searchtimespanmonths"
).split()
SIDE_EFFECTS = "outputlookup collect delete sendemail outputcsv mcollect meventcollect".split()
WHOLE_SET = (
    "head tail dedup sort streamstats eventstats transaction stats top rare chart timechart table reverse uniq "
    "autoregress delta accum trendline predict localize concurrency"
).split()
TIME_IGNORING = "inputlookup inputcsv makeresults gentimes rest dbxquery ldapsearch".split()

MODIFIER = rf"(?i)(?<![\w.])({'|'.join(TIME_MODIFIERS)})\s*="
SIDE_EFFECT = rf"(?i)\|\s*({'|'.join(SIDE_EFFECTS)})\b"
WHOLE = rf"(?i)\|\s*({'|'.join(WHOLE_SET)})\b"
IGNORING = rf"(?i)^\|\s*({'|'.join(TIME_IGNORING)})\b"


def normalize_search(search: Column) -> Column:
    """The search with a leading ``search`` unless it has one or starts with a pipe; null if empty."""
    s = F.trim(search)
    kept = s.startswith("|") | s.rlike(r"(?i)^search\b")
    return F.when(F.length(s) > 0, F.when(kept, s).otherwise(F.concat(F.lit("search "), s)))


def search_hash(search: Column) -> Column:
    return F.sha2(search.cast("binary"), 256)


def is_whole_set(search: Column) -> Column:
    return search.rlike(WHOLE)


def lint_searches(df: DataFrame, search: str = "search") -> DataFrame:
    """A row for each issue of each search: the columns of ``df`` with level, kind and word.

    Errors: the first inline time modifier, the first side effect. Warnings: every whole-set command,
    and a generating command at the head.
    """
    s = F.col(search)

    def issues(level: str, kind: str, words: Column) -> Column:
        return F.transform(words, lambda w: F.struct(F.lit(level).alias("level"), F.lit(kind).alias("kind"), w.alias("word")))

    first = lambda pattern: F.filter(F.array(F.regexp_extract(s, pattern, 1)), lambda w: w != "")
    head = F.when(s.rlike(IGNORING), first(IGNORING)).when(s.startswith("|"), F.array(F.lit("|"))).otherwise(F.array().cast("array<string>"))
    found = F.concat(
        issues("error", "time modifier", first(MODIFIER)),
        issues("error", "side effect", first(SIDE_EFFECT)),
        issues("warning", "whole set", F.regexp_extract_all(s, F.lit(WHOLE), 1)),
        issues("warning", "generating", head),
    )
    return df.withColumn("_issue", F.explode(found)).select(*df.columns, "_issue.level", "_issue.kind", "_issue.word")
