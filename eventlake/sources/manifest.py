"""A manifest of chunks with versions: a log of commits that are made whole or not at all.

A version is one small file in ``commits/``, named by its number and created only if it is not there yet; it names the
folders of the changes that it adds: rows of chunks, rows of the log, and the run. Data is written first, so a crash
before the commit leaves the version before it, and folders that no version names are never read. Of two writers of
the same version, one loses and applies its change to what the other made. Any version can be read again.

A chunk's state at a version is its row of the latest change up to there. Every ``CHECKPOINT_EVERY`` versions a commit
holds all chunks, so that reading does not grow with the number of versions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHECKPOINT_EVERY = 20
RETRIES = 20

#: Columns that a manifest adds to those of a plan, with the state of a chunk that was never claimed.
STATE = {
    "status": ("string", "pending"), "attempts": ("long", 0), "worker": ("string", None), "written": ("long", None),
    "multiline": ("long", None), "error": ("string", None), "path": ("string", None), "not_before": ("long", None),
}
FILES = "array<struct<file:string,lines:bigint,bytes:bigint,hash_sum:decimal(38,0),hash_xor:bigint>>"
LOG = "ts double, chunk long, kind string, detail string"


class Conflict(Exception):
    """Another writer made this version."""


@dataclass
class Change:
    """Rows of chunks that are new or replace those of their id, and rows of the log."""

    chunks: DataFrame | None = None
    log: DataFrame | None = None


class Manifest:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- commits ----------------------------------------------------------------------------

    def _hadoop(self, path: str):
        made = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return made, made.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder, system = self._hadoop(f"{self.path}/commits")
        if not system.exists(folder):
            return []
        names = [s.getPath().getName() for s in system.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def _entry(self, version: int) -> dict:
        made, system = self._hadoop(f"{self.path}/commits/{version:012d}.json")
        stream = system.open(made)
        try:
            raw = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(raw)

    def _commit(self, version: int, entry: dict) -> None:
        """Create the file of a version, or raise :class:`Conflict` if it is there.

        Its text is written beside it and moved without replacing, so that it is never seen in part. A shared file
        system does this at its name server; a local one by a link, which fails if the name is taken.
        """
        target, system = self._hadoop(f"{self.path}/commits/{version:012d}.json")
        system.mkdirs(target.getParent())
        beside, _ = self._hadoop(f"{self.path}/commits/.{uuid.uuid4().hex}")
        stream = system.create(beside, False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        jvm = self.spark._jvm
        try:
            if system.getScheme() == "file":
                local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
                jvm.java.nio.file.Files.createLink(local(target), local(beside))
            else:
                options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration()).rename(beside, target, options)
        except Exception as error:
            if system.exists(target):
                raise Conflict(f"version {version} is taken") from error
            raise
        finally:
            if system.exists(beside):
                system.delete(beside, False)

    def _write(self, df: DataFrame | None, kind: str) -> list[str]:
        if df is None:
            return []
        name = f"data/{kind}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        return [name]

    # -- reading ----------------------------------------------------------------------------

    def _entries(self, version: int | None) -> list[dict]:
        """Commits from the last that holds all chunks up to a version."""
        known = self.versions()
        upto = [v for v in known if version is None or v <= version]
        if not upto or (version is not None and version not in known):
            raise ValueError(f"there is no version {version} of {self.path}")
        found = []
        for v in reversed(upto):
            found.append(self._entry(v) | {"version": v})
            if found[-1]["whole"]:
                break
        return found[::-1]

    def chunks(self, version: int | None = None) -> DataFrame:
        """The chunks at a version (the latest by default)."""
        parts = []
        for entry in self._entries(version):
            for name in entry["chunks"]:
                parts.append(self.spark.read.parquet(f"{self.path}/{name}").select(F.struct("*").alias("row"), F.col("id").alias("key"), F.lit(entry["version"]).alias("at")))
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows.groupBy("key").agg(F.max_by("row", "at").alias("row")).select("row.*")

    def run(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self._entry(0)['run'][0]}")

    def log(self, version: int | None = None) -> DataFrame:
        """Transitions up to a version, with the version that made them."""
        upto = [v for v in self.versions() if version is None or v <= version]
        parts = [(v, name) for v in upto for name in self._entry(v)["log"]]
        rows = self.spark.createDataFrame([], LOG + ", version long")
        for v, name in parts:
            rows = rows.unionByName(self.spark.read.parquet(f"{self.path}/{name}").select("ts", "chunk", "kind", "detail", F.lit(v).cast("long").alias("version")))
        return rows

    # -- writing ----------------------------------------------------------------------------

    def create(self, run: DataFrame, plan: DataFrame) -> None:
        """Run and chunks together, as version 0; an error if the manifest exists. ``plan`` has id, day, start, end and more."""
        missing = {name: F.lit(first).cast(kind) for name, (kind, first) in STATE.items() if name not in plan.columns}
        if "parent" not in plan.columns:
            missing["parent"] = F.lit(None).cast("long")
        if "files" not in plan.columns:
            missing["files"] = F.array().cast(FILES)
        if self.versions():
            raise ValueError(f"{self.path} is a manifest already")
        entry = {"whole": True, "what": "create", "chunks": self._write(plan.withColumns(missing), "chunks"), "log": [], "run": self._write(run, "run")}
        try:
            self._commit(0, entry)
        except Conflict as error:
            raise ValueError(f"{self.path} is a manifest already") from error

    def update(self, what: str, change: Callable[[DataFrame], Change], retries: int = RETRIES) -> int:
        """Commit what ``change`` makes of the latest chunks; it is applied anew if another writer was first. The version."""
        for _ in range(retries):
            version = self.versions()[-1]
            made = change(self.chunks(version))
            whole = (version + 1) % CHECKPOINT_EVERY == 0
            rows = made.chunks
            if whole:
                rows = _replaced(self.chunks(version), rows)
            log = made.log.select(F.col("ts").cast("double"), F.col("chunk").cast("long"), "kind", F.substring("detail", 1, 4000).alias("detail")) if made.log is not None else None
            entry = {"whole": whole, "what": what, "chunks": self._write(rows, "chunks"), "log": self._write(log, "log"), "run": []}
            try:
                self._commit(version + 1, entry)
                return version + 1
            except Conflict:
                continue
        raise Conflict(f"no version of {self.path} after {retries} tries")

    def claim(self, worker: str, most: int, now: int, oldest_first: bool = True) -> DataFrame:
        """Up to ``most`` pending chunks, now running for a worker; no two workers get the same."""
        order = F.col("start").asc() if oldest_first else F.col("start").desc()

        def change(chunks: DataFrame) -> Change:
            ready = chunks.where("status = 'pending'").where(F.coalesce(F.col("not_before") <= now, F.lit(True)))
            taken = ready.orderBy(order, "id").limit(most)
            taken = taken.withColumns({"status": F.lit("running"), "worker": F.lit(worker), "attempts": F.col("attempts") + 1, "error": F.lit(None).cast("string")})
            return Change(taken, _log(taken, now, "running", F.lit(worker)))

        version = self.update("claim", change)
        return self.chunks(version).where((F.col("status") == "running") & (F.col("worker") == worker))

    def finish(self, outcomes: DataFrame, now: int) -> int:
        """Set columns of running chunks by id: ``outcomes`` has id and some of the manifest's columns, such as status."""

        def change(chunks: DataFrame) -> Change:
            given = [c for c in outcomes.columns if c != "id"]
            new = outcomes.select(F.col("id").alias("key"), *[F.col(c).alias(f"new_{c}") for c in given])
            joined = chunks.where("status = 'running'").join(new, F.col("id") == F.col("key"))
            rows = joined.withColumns({c: F.col(f"new_{c}").cast(chunks.schema[c].dataType) for c in given}).select(*chunks.columns)
            return Change(rows, _log(rows, now, F.col("status"), F.coalesce("error", F.lit(""))))

        return self.update("finish", change)

    def split(self, halves: DataFrame, now: int) -> int:
        """Mark chunks split and add their children, once: ``halves`` has parent, day, start and end. Parents that were split stay as they are."""

        def change(chunks: DataFrame) -> Change:
            parents = chunks.where("status <> 'split'").join(halves.select(F.col("parent").alias("id")).distinct(), "id", "left_semi")
            rows = parents.withColumn("status", F.lit("split"))
            top = chunks.agg(F.max("id").alias("top"))
            first = {name: F.lit(value).cast(kind) for name, (kind, value) in STATE.items()} | {"files": F.array().cast(FILES)}
            fresh = halves.join(parents.select(F.col("id").alias("parent")), "parent", "left_semi").crossJoin(top)  # one row
            # Halves of one commit are few beside its chunks: those that overflowed.
            number = F.row_number().over(Window.orderBy("parent", "start"))
            fresh = fresh.withColumn("id", F.col("top") + number).drop("top")
            fresh = fresh.withColumns({name: value for name, value in first.items() if name in chunks.columns})
            rest = {c: F.lit(None).cast(chunks.schema[c].dataType) for c in chunks.columns if c not in fresh.columns}
            return Change(rows.unionByName(fresh.withColumns(rest).select(*chunks.columns)), _log(rows, now, "split", F.lit("")))

        return self.update("split", change)

    def requeue(self, now: int, failed: bool = True) -> int:
        """Put running chunks back, giving their attempt back, and with ``failed`` also failed and mismatched ones, from the start."""

        def change(chunks: DataFrame) -> Change:
            running = F.col("status") == "running"
            wanted = running | (F.col("status").isin("failed", "mismatch") if failed else F.lit(False))
            attempts = F.when(running, F.greatest(F.col("attempts") - 1, F.lit(0))).otherwise(0).cast("long")
            rows = chunks.where(wanted).withColumns({
                "attempts": attempts, "status": F.lit("pending"), "worker": F.lit(None).cast("string"), "error": F.when(running, F.col("error")),
            })
            return Change(rows, _log(rows, now, "requeued", F.lit("")))

        return self.update("requeue", change)


def _log(rows: DataFrame, now: int, kind: str | Column, detail: Column) -> DataFrame:
    return rows.select(F.lit(now).cast("double").alias("ts"), F.col("id").alias("chunk"), (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), detail.alias("detail"))


def _replaced(chunks: DataFrame, rows: DataFrame | None) -> DataFrame:
    return chunks if rows is None else chunks.join(rows.select("id"), "id", "left_anti").unionByName(rows.select(*chunks.columns))
