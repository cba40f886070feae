"""Moving a side: what to export, what to leave out, what still has to be restored."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableshift.operators.constraints import Rules, constraint_report
from tableshift.operators.graph import reach
from tableshift.sources.versions import NotPublished, VersionStore, matches_any


def filter_listing(lines: DataFrame, line: str, pattern: str) -> DataFrame:
    """Add ``skipped`` where the pattern of what a platform owns is found, and put ``;`` before the listing lines a restore must leave alone."""
    skipped = F.col(line).rlike(pattern)
    return (lines.withColumn("skipped", skipped)
            .withColumn(line, F.when(F.col("skipped"), F.concat(F.lit(";"), F.col(line))).otherwise(F.col(line))))


def listing_counts(filtered: DataFrame, by: str = "database") -> DataFrame:
    return filtered.groupBy(by).agg(F.count(F.lit(1)).alias("entries"), F.count_if("skipped").alias("skipped"))


def excluded_names(names: DataFrame, name: str, patterns: Sequence[str], depends_on: DataFrame | None = None) -> DataFrame:
    """(name, reason): names that match a pattern, and everything that depends on them, however far.

    ``depends_on`` has (name, needed): leaving out a table without the view over it would break the restore.
    """
    direct = names.filter(matches_any(F.col(name), patterns)).select(F.col(name).alias("name")).distinct()
    if depends_on is None:
        return direct.withColumn("reason", F.lit("pattern"))
    edges = depends_on.select(F.col("needed").alias("source"), F.col("name").alias("target")).distinct()
    everything = reach(direct, edges, "name")
    return (everything.join(direct.withColumn("hit", F.lit(True)), "name", "left")
            .select("name", F.when(F.col("hit"), "pattern").otherwise("depends").alias("reason")))


def pending_restores(requested: DataFrame, published: DataFrame, attempts: DataFrame) -> DataFrame:
    """(database, first_started, attempts) of requested databases that hold no tables yet.

    A restore that is tried again keeps the start of its first attempt.
    """
    todo = requested.select("database").distinct().join(published.select("database").distinct(), "database", "left_anti")
    tried = attempts.groupBy("database").agg(F.min("started").alias("first_started"), F.count(F.lit(1)).alias("attempts"))
    return (todo.join(tried, "database", "left")
            .select("database", "first_started", F.coalesce("attempts", F.lit(0)).cast("bigint").alias("attempts")))


def move_plan(listing: DataFrame, published: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """(database, tables, size, excluded, pending) over a (database, table, size) listing."""
    out = matches_any(F.col("table"), exclude)
    per_database = (listing.withColumn("out", out).groupBy("database")
                    .agg(F.count_if(~F.col("out")).alias("tables"), F.count_if("out").alias("excluded"),
                         F.coalesce(F.sum(F.when(~F.col("out"), F.col("size"))), F.lit(0)).alias("size")))
    done = published.select("database").distinct().withColumn("done", F.lit(True))
    return (per_database.join(done, "database", "left")
            .select("database", "tables", "size", "excluded", F.col("done").isNull().alias("pending")))


def restore(source: VersionStore, target: VersionStore, committed_at: int, *, version: int | None = None,
            exclude: Sequence[str] = (), rules: Mapping[str, Rules] | None = None, tag: str | None = None) -> int:
    """Restore a version into another store, all or nothing.

    Every table is written, compared with the exported fingerprint and checked against its rules before one manifest
    file makes the new version visible.
    """
    version = source.latest_version() if version is None else version
    entries = source._entries(version)
    wanted = {e["table"]: (e["rows"], e["digest"]) for e in entries
              if not any(re.search(p, e["table"]) for p in exclude)}

    def broken(written):
        return constraint_report(written, checked).filter("violations > 0")

    if not wanted:
        raise NotPublished("there is nothing to restore")
    checked = {name: r for name, r in (rules or {}).items() if name in wanted}
    tables = source.tables(version)
    return target.export({name: tables[name] for name in wanted}, committed_at, tag, expect=wanted,
                         validate=broken if checked else None)
