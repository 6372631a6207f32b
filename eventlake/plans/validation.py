"""The validation job: checks over a manifest of chunks, at four cumulative levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.encoding import encode_json
from eventlake.functions.messages import has_level
from eventlake.operators.chunks import assign_chunks, sample_chunks
from eventlake.sources.events import pin_snapshot
from eventlake.sources.sinks import keep

LEVELS = ("job", "plan", "total", "full")
MOST_GAPS = 20


def leaves(chunks: DataFrame) -> DataFrame:
    return chunks.where("status <> 'split'")


def done(chunks: DataFrame) -> DataFrame:
    return chunks.where("status = 'done'")


def coverage_gaps(leaf: DataFrame, earliest: int, latest: int) -> DataFrame:
    """(kind, start, end): why leaves don't tile the range; at most MOST_GAPS rows.

    Leaves are ordered within their day; only the first leaf of each day is looked at across days.
    """
    leaf = leaf.select("start", "end").withColumn("day", F.floor(F.col("start") / 86400))
    w = Window.partitionBy("day").orderBy("start", "end")
    days = leaf.groupBy("day").agg(F.min(F.struct("start", "end")).alias("opens"))
    days = days.select("day", F.lead("opens").over(Window.orderBy("day")).alias("opens"), (F.lag("opens").over(Window.orderBy("day"))).isNull().alias("earliest"))
    s = leaf.withColumn("follows", F.lead(F.struct("start", "end")).over(w)).withColumn("place", F.row_number().over(w))
    s = s.join(days, "day").withColumn("follows", F.coalesce("follows", "opens")).withColumn("first", F.col("earliest") & (F.col("place") == 1))
    s = s.select("start", "end", F.col("follows.start").alias("next"), F.col("follows.end").alias("next_end"), "first")
    issue = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.cast("long").alias("start"), b.cast("long").alias("end"))
    start, end, follows = F.col("start"), F.col("end"), F.col("next")
    found = F.array(
        F.when(F.col("first") & (start != earliest), issue("first", start, F.lit(earliest))),
        F.when(follows.isNull() & (end != latest), issue("last", end, F.lit(latest))),
        F.when(end <= start, issue("empty", start, end)),
        F.when(end < follows, issue("gap", end, follows)),
        F.when(end > follows, issue("overlap", follows, F.least(end, F.col("next_end")))),
    )
    gaps = s.select(F.explode(F.filter(found, lambda x: x.isNotNull())).alias("g")).select("g.*")
    none = leaf.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("no chunks").alias("kind"), F.lit(earliest).cast("long").alias("start"), F.lit(latest).cast("long").alias("end"))
    return gaps.unionByName(none).orderBy("start", "end", "kind").limit(MOST_GAPS)


def split_rollup(chunks: DataFrame) -> DataFrame:
    """Split chunks with a known count: what all leaves below them wrote, and whether it adds up.

    Leaves climb to their parents level by level, until all are at the top; each level is kept as a table. A
    chunk that is its own ancestor is an error. ``chunks`` has id, parent, status, expected and written.
    """
    climb = leaves(chunks).select(F.col("parent").alias("at"), F.coalesce("written", F.lit(0)).alias("written")).where("at IS NOT NULL")
    climb = keep(climb.groupBy("at").agg(F.sum("written").alias("written")), "climb")
    parents = keep(chunks.where("status = 'split'").select("id", "parent"), "parents")
    most = parents.count()
    levels = [climb]
    while True:
        above = climb.join(parents, climb["at"] == parents["id"]).select(F.col("parent").alias("at"), "written").where("at IS NOT NULL")
        climb = keep(above.groupBy("at").agg(F.sum("written").alias("written")), "climb")
        if climb.isEmpty():
            break
        levels.append(climb)
        if len(levels) > most:
            raise ValueError("a split chunk lies below itself")
    below = reduce(DataFrame.unionByName, levels).groupBy("at").agg(F.sum("written").alias("children"))
    split = chunks.where("status = 'split' AND expected IS NOT NULL")
    return split.join(below, split["id"] == below["at"], "left").select(
        "id", "expected", F.coalesce("children", F.lit(0)).alias("children"), (F.col("expected") == F.coalesce("children", F.lit(0))).alias("ok")
    )


def run_totals(chunks: DataFrame) -> DataFrame:
    """What done and mismatched chunks wrote."""
    kept = chunks.where("status IN ('done', 'mismatch')")
    return kept.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("written", "bytes", "utf8_replacements", "multiline")])


def vacuous(chunks: DataFrame) -> DataFrame:
    """One row: whether no top-level done chunk has a known count although there are such chunks."""
    top = done(chunks).where("parent IS NULL")
    return top.agg((F.count("*") > 0).alias("some"), F.count("expected").alias("known")).select((F.col("some") & (F.col("known") == 0)).alias("vacuous"))


HASHES = ("hash_sum", "hash_xor")


def files_vs_manifest(files: DataFrame, chunks: DataFrame) -> DataFrame:
    """Files against done chunks by path: missing on either side, unreadable, or with wrong lines.

    ``files`` has path and lines, and may have ``files`` (how many there are) and the hashes of
    :func:`~eventlake.sources.sinks.written_files`. Hashes are compared for paths of one chunk, if both sides
    have them. With ``files``, a chunk without lines needs no file, and a file without a line of those it should have is unreadable.
    With ``problem`` (of :func:`~eventlake.sources.members.checked_files`), so is one whose gzip members are not whole, whatever
    its lines are.
    """
    hashed = all(h in df.columns for h in HASHES for df in (files, chunks))
    one = [F.when(F.count("*") == 1, F.first(h)).alias(f"planned_{h}") for h in HASHES] if hashed else []
    planned = done(chunks).groupBy("path").agg(F.sum(F.coalesce("written", F.lit(0)) + F.coalesce("multiline", F.lit(0))).alias("expected_lines"), *one)
    problem = "problem" in files.columns
    joined = planned.join(files.select("path", "lines", *(HASHES if hashed else ()), *(["problem"] if problem else [])), "path", "full_outer")
    other = F.lit(False)
    for h in HASHES if hashed else ():
        other = other | F.coalesce(F.col(h).cast("decimal(38,0)") != F.col(f"planned_{h}").cast("decimal(38,0)"), F.lit(False))
    state = (
        F.when(F.col("path").isNull(), "no path")
        .when(F.col("lines").isNull() & (F.col("expected_lines") == 0) & F.lit("files" in files.columns), "ok")
        .when(F.col("lines").isNull(), "missing file")
        .when(F.col("expected_lines").isNull(), "unknown file")
        .when(F.col("problem").isNotNull() if problem else F.lit(False), "unreadable file")
        .when((F.col("lines") == 0) & (F.col("expected_lines") > 0) & F.lit("files" in files.columns), "unreadable file")
        .when(F.col("lines") != F.col("expected_lines"), "wrong lines")
        .when(other, "wrong content")
        .otherwise("ok")
    )
    return joined.select("path", F.coalesce("expected_lines", F.lit(0)).alias("expected_lines"), F.coalesce("lines", F.lit(0)).alias("lines"), state.alias("state"))


def sample_differences(written: DataFrame, again: DataFrame, keys: tuple[str, ...] = ("chunk",)) -> DataFrame:
    """Chunks of a sample whose lines are not those of a second extraction, as multisets: keys and differing lines.

    Both have the keys and ``line``. Lines are counted before they meet, so that repeated ones cost a row.
    """
    both = written.select(*keys, "line", F.lit(1).alias("sign")).unionByName(again.select(*keys, "line", F.lit(-1).alias("sign")))
    off = both.groupBy(*keys, "line").agg(F.sum("sign").alias("off")).where("off <> 0")
    return off.groupBy(*keys).agg(F.sum(F.abs("off")).alias("lines"))


def own_files(chunks: DataFrame) -> DataFrame:
    """Done chunks that share their path with no other; those of compacted days do."""
    finished = done(chunks)
    alone = finished.where("path IS NOT NULL").groupBy("path").agg(F.count("*").alias("sharing")).where("sharing = 1").select("path")
    return finished.join(alone, "path", "left_semi")


def sample_reextract(
    chunks: DataFrame, events: DataFrame, written: DataFrame, n: int, seed: str, fields: list[str] | None = None, pin: int | None = None, zone: str = "UTC"
) -> DataFrame:
    """Of ``n`` done chunks that own their files, those whose lines differ from a new extraction: chunk and differing lines.

    The chunks are extracted again from the events, under the pin of the run; ``written`` has the lines of the output, with
    ``chunk``. Chunks of compacted days are not sampled, as their lines can't be told apart. At most ``n`` chunks are broadcast.
    """
    picked = sample_chunks(own_files(chunks), n, seed).select("day", "start", "end")
    picked = keep(picked.withColumn("chunk", F.concat_ws("-", F.col("start").cast("string"), F.col("end").cast("string"))), "sample")
    assigned = assign_chunks(pin_snapshot(events, pin), picked, zone, keys=("start", "end", "chunk"))
    names = [c for c in events.columns if not fields or c in fields]
    again = assigned.select(F.col("chunk_chunk").alias("chunk"), encode_json(assigned, fields or names).alias("line"))
    return sample_differences(written.join(F.broadcast(picked.select("chunk")), "chunk", "left_semi"), again)


ISSUE = "id long, path string, issue string, found string"


def chunk_issues(chunks: DataFrame, files: DataFrame | None = None, recount: DataFrame | None = None, sample: DataFrame | None = None) -> DataFrame:
    """(id, path, issue, found): each chunk that a check speaks against, and what was found.

    The arguments are those of :func:`validate`; a chunk may have several issues.
    """
    open_ = leaves(chunks).where("status <> 'done'").select("id", "path", F.lit("status").alias("issue"), F.col("status").alias("found"))
    finished = done(chunks)
    differs = lambda df, issue, found: df.select("id", "path", F.lit(issue).alias("issue"), F.col(found).cast("string").alias("found"))
    parts = [open_, differs(finished.where("mode = 'job' AND written <> result_count"), "resultCount", "result_count")]
    parts.append(differs(finished.where("written <> expected"), "expected", "expected"))
    if files is not None:
        bad = files_vs_manifest(files, chunks).where("state <> 'ok' AND path IS NOT NULL").select("path", "state", "lines")
        what = F.when(F.col("state") == "wrong lines", F.concat_ws(" ", "state", F.col("lines").cast("string"))).otherwise(F.col("state"))
        parts.append(finished.join(bad.withColumn("what", what), "path").select("id", "path", F.lit("file").alias("issue"), F.col("what").alias("found")))
        parts.append(finished.where("path IS NULL").select("id", "path", F.lit("file").alias("issue"), F.lit("no path").alias("found")))
    if recount is not None:
        again = finished.join(recount.select("start", "end", "n"), ["start", "end"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
        parts.append(differs(again.where("n <> written"), "recount", "n"))
    if sample is not None:
        name = F.concat_ws("-", F.col("start").cast("string"), F.col("end").cast("string"))
        other = finished.withColumn("chunk", name).join(sample.select("chunk", F.col("lines").alias("differ")), "chunk")
        parts.append(differs(other, "reextract", "differ"))
    return reduce(DataFrame.unionByName, parts)


def validate(
    chunks: DataFrame,
    earliest: int,
    latest: int,
    level: str = "total",
    total: DataFrame | None = None,
    files: DataFrame | None = None,
    recount: DataFrame | None = None,
    sample: DataFrame | None = None,
    strict: bool = True,
    used_histogram: bool = True,
    notes: bool = False,
) -> DataFrame:
    """(name, ok, bad): one row for each check of the level and those below it.

    ``total``: one row with an independent count ``n``; ``files``: see :func:`files_vs_manifest`; ``recount``:
    start, end and ``n``; ``sample``: rows of :func:`sample_differences`. Checks whose evidence is not given are
    left out. With ``notes``, replaced bytes are a row that is always ok, and ``detail`` says what was found.
    """
    upto = LEVELS.index(level)

    def check(name: str, bad: DataFrame) -> DataFrame:
        return bad.agg(F.count("*").alias("bad")).select(F.lit(name).alias("name"), (F.col("bad") == 0).alias("ok"), "bad")

    finished = done(chunks)
    loud = ("ERROR", "FATAL", "WARN") if strict else ("ERROR", "FATAL")
    checks = [
        check("coverage", coverage_gaps(leaves(chunks), earliest, latest)),
        check("all-chunks-done", leaves(chunks).where("status <> 'done'")),
        check("written-eq-resultCount", finished.where("mode = 'job' AND written <> result_count")),
        check("no-job-warnings", finished.where(has_level(F.col("messages"), *loud))),
    ]
    if upto >= 1:
        wrong = finished.where("written <> expected").select("id")
        empty = vacuous(chunks).where("vacuous").where(F.lit(used_histogram)).select(F.lit(-1).cast("long").alias("id"))
        checks.append(check("written-eq-expected", wrong.unionByName(empty)))
        checks.append(check("split-parents-eq-children", split_rollup(chunks).where("NOT ok")))
    if upto >= 2 and total is not None:
        written = finished.agg(F.coalesce(F.sum("written"), F.lit(0)).alias("written"))
        unfinished = leaves(chunks).where("status <> 'done'").agg(F.count("*").alias("unfinished"))
        off = written.crossJoin(total.select("n")).crossJoin(unfinished).where("written <> n OR unfinished > 0")
        checks.append(check("total-count", off))
    if upto >= 3 and files is not None:
        checks.append(check("files-intact", files_vs_manifest(files, chunks).where("state <> 'ok'")))
    if upto >= 3 and recount is not None:
        again = finished.join(recount.select("start", "end", "n"), ["start", "end"], "left")
        checks.append(check("per-chunk-recount", again.where("coalesce(n, 0) <> written")))
    if upto >= 3 and sample is not None:
        checks.append(check("sample-reextract", sample))
    if notes:
        replaced = finished.agg(F.coalesce(F.sum("utf8_replacements"), F.lit(0)).alias("bad"))
        checks.append(replaced.select(F.lit("utf8-replacements").alias("name"), F.lit(True).alias("ok"), "bad"))
    found = reduce(DataFrame.unionByName, checks)
    return found.withColumn("detail", detail()) if notes else found


#: What the number of a check counts; others count chunks.
COUNTED = {
    "coverage": "gaps or overlaps", "total-count": "differences of the total", "files-intact": "paths", "split-parents-eq-children": "split chunks",
    "utf8-replacements": "replaced sequences",
}


def detail() -> Column:
    """A check's number with what it counts, such as ``3 paths``."""
    what = F.lit("chunks")
    for name, counted in COUNTED.items():
        what = F.when(F.col("name") == name, counted).otherwise(what)
    return F.concat_ws(" ", F.col("bad").cast("string"), what)


def run_verdict(chunks: DataFrame, checks: DataFrame) -> DataFrame:
    """One row: ok if no leaf is unfinished and every check passed."""
    open_ = chunks.where("status IN ('pending', 'running', 'failed', 'mismatch')").agg((F.count("*") == 0).alias("finished"))
    return open_.crossJoin(checks.agg(F.bool_and("ok").alias("passed"))).select((F.col("finished") & F.col("passed")).alias("ok"))


def write_report(checks: DataFrame, issues: DataFrame, path: str) -> str:
    """Write checks and chunks with issues as JSON under ``path``; returns a Markdown table of the checks."""
    checks.coalesce(1).write.mode("overwrite").json(f"{path}/checks")
    issues.write.mode("overwrite").json(f"{path}/chunks_with_issues")
    rows = "".join(f"| {r['name']} | {'ok' if r['ok'] else 'FAIL'} | {r['bad']} |\n" for r in checks.orderBy("name").collect())
    return "| check | result | bad |\n|-|-|-|\n" + rows
