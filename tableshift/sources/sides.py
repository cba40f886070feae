"""A side is a named set of tables, grouped by database: an old home, a new home, a branch."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEMPLATE_DATABASES = ("template0", "template1", "postgres")


@dataclass(frozen=True)
class Side:
    """Tables of one side, by (database, table)."""

    name: str
    tables: Mapping[tuple[str, str], DataFrame] = field(default_factory=dict)

    @classmethod
    def of(cls, name: str, databases: Mapping[str, Mapping[str, DataFrame]]) -> Side:
        return cls(name, {(db, t): df for db, tables in databases.items() for t, df in tables.items()})

    @classmethod
    def from_catalog(cls, spark: SparkSession, name: str, databases: Sequence[str]) -> Side:
        """Every base table of the named catalog schemas."""
        return cls(name, {(db, t): spark.table(f"`{db}`.`{t}`")
                          for db in databases for t in list_base_tables(spark, db)})

    def databases(self) -> list[str]:
        return sorted({db for db, _ in self.tables})

    def table(self, database: str, table: str) -> DataFrame:
        return self.tables[(database, table)]

    def with_table(self, database: str, table: str, df: DataFrame) -> Side:
        return Side(self.name, {**self.tables, (database, table): df})


def scan(spark: SparkSession, sql: str, args: Mapping | None = None, **tables: DataFrame) -> DataFrame:
    """A query with named parameters (``:name``); ``{table}`` stands for a frame. Values are never pasted into the text."""
    return spark.sql(sql, args=dict(args or {}), **tables)


def union_all(frames: Iterable[DataFrame], schema: str | None = None) -> DataFrame:
    """All rows of the frames; of no frames, an empty one of the schema."""
    frames = list(frames)
    if not frames and schema:
        return SparkSession.active().createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b), frames)


def tagged_union(frames: Mapping[str, DataFrame], tag: str = "database") -> DataFrame:
    """The same query over many databases as one frame, each row tagged with where it came from."""
    return union_all(df.select(F.lit(name).alias(tag), *df.columns) for name, df in frames.items())


def list_base_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if t.tableType != "VIEW" and not t.isTemporary)


def databases_of(listing: DataFrame, skip: Sequence[str] = TEMPLATE_DATABASES) -> DataFrame:
    """Databases in a (database, schema, table, kind) listing, except templates and built-in ones."""
    return (listing.filter(~F.col("database").isin(*skip))
            .groupBy("database").agg(F.count(F.lit(1)).alias("entries")))


def base_tables(listing: DataFrame, schema: str) -> DataFrame:
    return (listing.filter((F.col("schema") == schema) & (F.col("kind") == "BASE TABLE"))
            .select("database", "table"))


def with_has_tables(requested: DataFrame, listing: DataFrame, schema: str) -> DataFrame:
    """Whether each requested database already holds a base table in the schema."""
    held = base_tables(listing, schema).groupBy("database").agg(F.count(F.lit(1)).alias("tables"))
    return (requested.join(held, "database", "left")
            .withColumn("tables", F.coalesce("tables", F.lit(0)).cast("bigint"))
            .withColumn("has_tables", F.col("tables") > 0))


def branch_view(parent: DataFrame, overlay: DataFrame, keys: Sequence[str], deleted: Column | str = "deleted") -> DataFrame:
    """A branch: the parent's rows with the branch's own rows on top; ``deleted`` overlay rows hide a parent row."""
    gone = F.col(deleted) if isinstance(deleted, str) else deleted
    kept = parent.join(overlay.select(*keys), list(keys), "left_anti")
    return kept.unionByName(overlay.filter(~gone).select(*parent.columns))


def common_names(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows present on both sides, once each, matching NULL with NULL."""
    return left.intersect(right)
