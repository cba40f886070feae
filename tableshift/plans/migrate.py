"""Numbered table changes, each applied exactly once and recorded in a ledger published together with it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableshift.functions.times import SECOND
from tableshift.sources.versions import VersionStore

LEDGER = "schema_migrations"
LEDGER_SCHEMA = "version int, description string, applied_at timestamp"


@dataclass(frozen=True)
class Migration:
    """``apply`` gets the current tables and returns those it adds or changes."""

    version: int
    description: str
    apply: Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]]


def migrate(store: VersionStore, migrations: Sequence[Migration], up_to: int, now: int, baseline: int = 0) -> list[int]:
    """Apply what the store's ledger lacks, in order, up to a version; return the versions in the ledger.

    Each change and its ledger row are one published version of the store, so a failure leaves the earlier ones in
    place. Versions at or below ``baseline`` count as already there.
    """
    spark = store.spark
    tables = store.tables()
    done = {r["version"] for r in tables[LEDGER].select("version").collect()} if LEDGER in tables else set()
    for step in sorted(migrations, key=lambda m: m.version):
        if step.version > up_to or step.version <= baseline or step.version in done:
            continue
        changed = dict(step.apply(tables))
        row = spark.createDataFrame([(step.version, step.description)], "version int, description string")
        row = row.withColumn("applied_at", F.timestamp_micros(F.lit(now)))
        changed[LEDGER] = tables[LEDGER].unionByName(row) if LEDGER in tables else row
        tables = store.tables(store.export(changed, now, f"V{step.version}", keep_others=True))
        done.add(step.version)
        now += SECOND
    return sorted(done)


def pending_migrations(databases: DataFrame, available: Mapping[int, str], ledger: DataFrame,
                       baseline: int = 0) -> DataFrame:
    """(database, version, description) still to apply, for many databases at once.

    ``databases`` has (database, up_to); ``ledger`` has (database, version).
    """
    steps = F.array(*[F.struct(F.lit(v).alias("version"), F.lit(d).alias("description"))
                      for v, d in sorted(available.items())])
    wanted = (databases.select("database", "up_to", F.inline(steps))
              .filter((F.col("version") <= F.col("up_to")) & (F.col("version") > baseline)).drop("up_to"))
    return wanted.join(ledger.select("database", "version").distinct(), ["database", "version"], "left_anti")


def ledger_history(ledger: DataFrame, expected: Sequence[int]) -> DataFrame:
    """(database, history, newest, as_expected): each database's applied versions against the expected list.

    A history holds each version once, so its text stays as short as the list of migrations.
    """
    text = ",".join(str(v) for v in sorted(expected))
    return (ledger.select("database", "version").distinct().groupBy("database")
            .agg(F.expr("listagg(cast(version as string), ',') within group (order by version)")
                 .alias("history"), F.max("version").alias("newest"))
            .withColumn("as_expected", F.col("history") == text))
