"""Events of a time range, and the test view of them over the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, VariantType

from eventlake.functions.encoding import decode_tolerant, select_fields
from eventlake.functions.times import epoch

DAY = 86400


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as events: epoch second ``t``, index time, raw text and the default fields."""
    e = read_table(spark, sf_dir, "events").withColumn("t", epoch(F.col("ts")))
    return e.select(
        "event_id",
        "t",
        F.col("ts").cast("timestamp").alias("_time"),
        (F.col("t") + (F.col("event_id") * 7919) % 3600).alias("_indextime"),
        F.concat_ws(" ", F.col("event_id").cast("string"), "event_type", "props").alias("_raw"),
        F.lit("main").alias("index"),
        F.col("event_type").alias("sourcetype"),
        F.lit("stream").alias("source"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("host"),
        F.col("user_id").alias("_bkt"),
        (F.col("event_id") % 50).alias("_cd"),
    )


def time_window(events: DataFrame, start: int, end: int, column: str = "t") -> DataFrame:
    """Events of the half-open range; adjacent ranges partition a table exactly."""
    return events.where((F.col(column) >= start) & (F.col(column) < end))


def pin_snapshot(events: DataFrame, pin: int | None, column: str = "_indextime") -> DataFrame:
    """Events indexed before the pin, so that repeated counts of a live table agree; None keeps all."""
    return events if pin is None else events.where(F.col(column) < pin)


def extract_events(events: DataFrame, start: int, end: int, pin: int | None = None, fields: list[str] | None = None) -> DataFrame:
    return select_fields(pin_snapshot(time_window(events, start, end), pin), fields)


def delta_window(events: DataFrame, start: int, end: int, old_pin: int, new_pin: int) -> DataFrame:
    """Late arrivals: events of the range that were indexed between two pins."""
    return pin_snapshot(time_window(events, start, end), new_pin).where(F.col("_indextime") >= old_pin)


def whole_days(events: DataFrame, column: str = "t") -> tuple[int, int]:
    """The range of whole UTC days that holds all events; (0, 0) without events."""
    lo, hi = events.agg(F.min(column), F.max(column)).first()
    return (0, 0) if lo is None else (lo // DAY * DAY, (hi // DAY + 1) * DAY)


# -- export streams -----------------------------------------------------------------------------

ENVELOPE = "preview boolean, offset long, lastrow boolean, result map<string,string>"

#: A line with something other than the spaces that JSON readers skip.
_SOMETHING = r"[^ \t\n\r\x0B\f]"


def read_export_stream(spark: SparkSession, path: str, malformed: str = "fail") -> DataFrame:
    """Envelopes of NDJSON files: lines split at ``\\n`` only, blank ones skipped, bytes decoded tolerantly.

    Columns: stream (file), replaced (invalid sequences), the parts of the envelope, ``json`` (the result as JSON text, so
    that lists stay lists) and ``malformed``. A line is malformed if it is not one JSON object, has a key twice, or has a
    result that is no object. Such a line ends the job with an error that shows it; with ``malformed="keep"`` it stays, with
    ``malformed`` true and no parts, so that :func:`stream_state` counts it. None is ever dropped.
    """
    if malformed not in ("fail", "keep"):
        raise ValueError("malformed lines fail or are kept")
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("stream"), F.col("value").cast("binary").alias("raw"))
    decoded = lines.withColumn("d", decode_tolerant(F.col("raw"))).where(F.col("d.text").rlike(_SOMETHING))
    decoded = decoded.select("stream", F.col("d.replaced").alias("replaced"), F.col("d.text").alias("text"))
    # Parsers stop behind the first value. So the line is put into a list before a mark of its own: what follows a value hides it.
    mark = F.hex(F.xxhash64("text"))
    value = F.try_parse_json(F.concat(F.lit("["), "text", F.lit(',"'), mark, F.lit('"]')))
    alone = F.coalesce(F.try_variant_get(value, "$[1]", "string") == mark, F.lit(False))
    result = F.try_variant_get(value, "$[0].result", "variant")
    as_text = F.get_json_object("text", "$.result")
    wrong = ~alone | ~F.col("text").rlike(r"^\s*\{") | F.coalesce(F.is_variant_null(result) | ~as_text.startswith("{"), F.lit(False))
    judged = decoded.withColumn("malformed", F.coalesce(wrong, F.lit(True)))
    if malformed == "fail":
        shown = F.concat(F.lit("malformed line in "), F.col("stream"), F.lit(": "), F.substring("text", 1, 200))
        # In a filter, so that it is looked at whatever columns are read.
        judged = judged.where(F.when(F.col("malformed"), F.raise_error(shown).cast("boolean")).otherwise(True))
    parts = F.when(~F.col("malformed"), F.from_json("text", ENVELOPE)).alias("e")
    made = judged.select("stream", "replaced", "malformed", parts, F.when(~F.col("malformed"), as_text).alias("json"))
    return made.select("stream", "replaced", "malformed", "e.*", "json")


def non_preview(envelopes: DataFrame) -> DataFrame:
    return envelopes.where(~F.coalesce("preview", F.lit(False)))


def export_rows(envelopes: DataFrame) -> DataFrame:
    return non_preview(envelopes).where("result IS NOT NULL").select("stream", "result", "replaced")


def export_lines(envelopes: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """stream, line, replaced: results as output lines, whose values keep their JSON types (lists, numbers, nulls).

    With ``fields``, those that a result has, in the listed order; without, all of them in their own order.
    """
    rows = non_preview(envelopes).where("json IS NOT NULL")
    line = F.col("json")
    if fields:
        named = StructType([StructField(name, VariantType()) for name in dict.fromkeys(fields)])
        line = F.to_json(F.from_json("json", named))
    return rows.select("stream", line.alias("line"), "replaced")


def stream_state(envelopes: DataFrame, expected: DataFrame) -> DataFrame:
    """Of each expected stream: rows, malformed lines, replaced sequences, and whether it is complete.

    A stream is complete if its last row was marked and none of its lines is malformed; an empty stream is not.
    """
    plain = ~F.coalesce("preview", F.lit(False))
    seen = envelopes.groupBy("stream").agg(
        F.count_if(plain & F.col("result").isNotNull()).alias("rows"),
        F.count_if("malformed").alias("malformed"),
        F.sum("replaced").alias("replaced"),
        F.bool_or(plain & F.coalesce("lastrow", F.lit(False))).alias("last"),
    )
    none = F.lit(0).cast("long")
    joined = expected.join(seen, "stream", "left").select("stream", *[F.coalesce(c, none).alias(c) for c in ("rows", "malformed", "replaced")], "last")
    return joined.withColumn("complete", F.coalesce("last", F.lit(False)) & (F.col("malformed") == 0)).drop("last")


def stream_complete(envelopes: DataFrame, expected: DataFrame) -> DataFrame:
    """stream, rows and complete of :func:`stream_state`."""
    return stream_state(envelopes, expected).select("stream", "rows", "complete")
