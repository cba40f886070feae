"""Exports: plain Parquet writes of a set of tables, a read-back comparison, and a list of what was exported.

Every attempt writes its tables into a fresh folder, reads them back and checks them; nothing that exists is ever
overwritten. Then the rows that name the folders are written, also as Parquet. A failed check or a crash before that
exports nothing. One writer at a time is assumed: a later one that finds its version there is refused, but no lock is held.
Reading a table at a moment is not done by versions: see ``operators/history.py``.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableshift.functions.text import any_of
from tableshift.functions.times import DAY, SECOND
from tableshift.operators.digest import bag_fingerprint, digest_columns
from tableshift.operators.history import NothingThere
from tableshift.session import work_folder

MANIFEST_SCHEMA = ("version bigint, committed_at bigint, tag string, table string, rows bigint, digest string, "
                   "columns string, path string")


class NotPublished(RuntimeError):
    """A check failed before publishing; the earlier versions are untouched."""


class VersionStore:
    """Versions of a set of tables below one folder."""

    def __init__(self, spark: SparkSession, root: str | None = None, parallel_tables: int = 4,
                 digest: Mapping[str, object] | None = None):
        """``digest`` gives the options of the tables' fingerprints; exact ones by default."""
        self.spark = spark
        self.root = (root or work_folder(spark, "versions")).rstrip("/")
        self.parallel_tables = parallel_tables
        self.digest = dict(digest or {})

    def manifest(self) -> DataFrame:
        """One row per published table of each version."""
        path = f"{self.root}/manifest"
        if not self._exists(path):
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return self.spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true").parquet(path)

    def _exists(self, path: str) -> bool:
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop_path)

    def _publish(self, version: int, entries: Sequence[Sequence]) -> None:
        """Write the version's manifest, a folder of its own; Spark shows it when it is complete, and refuses one that is there."""
        rows = self.spark.createDataFrame([tuple(e) for e in entries], MANIFEST_SCHEMA).coalesce(1)
        try:
            rows.write.mode("errorifexists").parquet(f"{self.root}/manifest/{version}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise NotPublished(f"version {version} was published by another writer") from e

    def latest_version(self) -> int | None:
        newest = latest_versions(self.manifest()).first()
        return newest["version"] if newest else None

    def export(self, tables: Mapping[str, DataFrame], committed_at: int, tag: str | None = None, *,
               exclude: Sequence[str] = (), expect: Mapping[str, tuple[int, str]] | None = None,
               validate: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None,
               keep_others: bool = False) -> int:
        """Publish the tables as the next version and return its number.

        ``exclude`` leaves out tables whose name matches a pattern, and proves they are not in the result. ``expect``
        gives fingerprints (rows, digest) the written tables must have. ``validate`` gets the written tables and returns
        a frame of problems, which must be empty. ``keep_others`` carries the last version's other tables over by
        reference.
        """
        wanted = {n: df for n, df in tables.items() if not any(re.search(p, n) for p in exclude)}
        latest = latest_versions(self.manifest()).first()
        version = latest["version"] + 1 if latest else 1
        if latest and committed_at <= latest["committed_at"]:
            raise NotPublished("a version must be committed after the one before it")
        attempt = uuid.uuid4().hex
        with ThreadPoolExecutor(self.parallel_tables) as pool:
            rows = list(pool.map(lambda item: self._write(attempt, *item), wanted.items()))
        for table, count, digest, *_ in rows:
            if expect is not None and expect.get(table) != (count, digest):
                raise NotPublished(f"{table} is not what was expected")
        if validate is not None:
            problems = validate({r[0]: self._open(r[3], r[4]) for r in rows})
            if not problems.isEmpty():
                raise NotPublished(f"version {version} failed validation and was not published")
        entries = [(version, committed_at, tag, *r) for r in rows]
        if keep_others and latest:
            entries += [(version, committed_at, tag, r["table"], r["rows"], r["digest"], r["columns"], r["path"])
                        for r in self._entries(latest["version"]) if r["table"] not in wanted]
        if any(re.search(p, e[3]) for e in entries for p in exclude):
            raise NotPublished("an excluded table is still in the export")
        self._publish(version, entries)
        return version

    def _write(self, attempt: str, table: str, df: DataFrame):
        """Write a table and prove the copy: what was sent and what is read back have one fingerprint."""
        path = f"{self.root}/data/{attempt}/{table}"
        seen = Observation()  # the fingerprint of what is sent is taken while it is written
        df.observe(seen, *digest_columns(df, **self.digest)).write.mode("errorifexists").parquet(path)
        sent = seen.get
        back = bag_fingerprint(self.spark.read.schema(df.schema).parquet(path), **self.digest).first()
        if (sent["rows"], sent["digest"]) != (back["rows"], back["digest"]):
            raise NotPublished(f"{table} differs after writing")
        return table, back["rows"], back["digest"], df.schema.json(), path

    def _entries(self, version: int):
        """One row per table of the version."""
        return self.manifest().filter(F.col("version") == version).collect()

    def read(self, table: str, version: int | None = None) -> DataFrame:
        version = self.latest_version() if version is None else version
        found = [e for e in self._entries(version) if e["table"] == table] if version is not None else []
        if not found:
            raise NothingThere(f"{table} is not in version {version}")
        return self._open(found[0]["columns"], found[0]["path"])

    def _open(self, columns: str, path: str) -> DataFrame:
        """A table by the schema its manifest row declares, so that no file is opened to find it out."""
        return self.spark.read.schema(T.StructType.fromJson(json.loads(columns))).parquet(path)

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        version = self.latest_version() if version is None else version
        return {e["table"]: self._open(e["columns"], e["path"]) for e in self._entries(version)} if version else {}


def latest_versions(versions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(…by, version, committed_at) of the newest (version, committed_at), none for no versions."""
    newest = F.max(F.struct("version", "committed_at")).alias("newest")
    return versions.groupBy(*by).agg(newest).filter("newest is not null").select(*by, "newest.version", "newest.committed_at")


def retention_plan(versions: DataFrame, now: int, ttl_seconds: int = 86_400, history_days: int = 7) -> DataFrame:
    """Add (expired, readable) to (version, committed_at, no_expiry): the newest version never expires.

    ``readable`` says the moment still lies in the history window, which is 2 to 30 days long.
    """
    if not 2 <= history_days <= 30:
        raise ValueError("the history window is 2 to 30 days")
    newest = versions.select(F.max("version")).scalar()
    old = F.col("committed_at") + ttl_seconds * SECOND < now
    return (versions.withColumn("expired", old & ~F.col("no_expiry") & (F.col("version") != newest))
            .withColumn("readable", F.col("committed_at") >= now - history_days * DAY))


def matches_any(name: Column, patterns: Sequence[str]) -> Column:
    return any_of([name.rlike(p) for p in patterns])


def unmatched_patterns(names: DataFrame, name: str, patterns: Sequence[str]) -> DataFrame:
    """Patterns that match no name, which an export would accept without a word. One pass counts all patterns."""
    counts = F.array(*[F.struct(F.lit(p).alias("pattern"), F.count_if(F.col(name).rlike(p)).alias("matches"))
                       for p in patterns])
    return names.agg(counts.alias("c")).select(F.inline("c")).filter("matches = 0").select("pattern")
