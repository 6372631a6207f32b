"""Job messages: parsing, levels and problems."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MESSAGES = "array<struct<type:string,text:string>>"


def parse_messages(text: Column) -> Column:
    """Messages of a JSON text: null gives none, types are upper case, missing parts empty."""
    found = F.coalesce(F.from_json(text, MESSAGES), F.array().cast(MESSAGES))
    return F.transform(
        found, lambda m: F.struct(F.upper(F.coalesce(m["type"], F.lit(""))).alias("type"), F.coalesce(m["text"], F.lit("")).alias("text"))
    )


def has_level(messages: Column, *levels: str) -> Column:
    return F.exists(messages, lambda m: m["type"].isin(*levels))


def problems(is_failed: Column, is_finalized: Column, messages: Column, strict: bool) -> Column:
    """Texts of what is wrong with a job: failed, finalized, and messages of bad levels."""
    levels = ("FATAL", "ERROR", "WARN") if strict else ("FATAL", "ERROR")
    bad = F.transform(F.filter(messages, lambda m: m["type"].isin(*levels)), lambda m: F.concat_ws(": ", m["type"], m["text"]))
    flag = lambda c, text: F.when(c, F.array(F.lit(text))).otherwise(F.array().cast("array<string>"))
    return F.concat(flag(is_failed, "job failed"), flag(is_finalized, "job was finalized"), bad)
