"""Table fingerprints: counts and content digests that do not depend on row order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableshift.functions.canon import EMPTY_DIGEST, bag_digest, row_md5
from tableshift.session import cut_lineage
from tableshift.sources.sides import Side, union_all

TABLES_PER_PLAN = 50
TREE_DEPTH = 6  # leading hex digits of a leaf: 16 million leaves, however many rows


def digest_columns(df: DataFrame, **options) -> list:
    """The two aggregates of a fingerprint, for use in ``agg`` or ``observe`` on ``hashed(df)``."""
    return [F.count(F.lit(1)).alias("rows"), bag_digest(row_md5(df, **options)).alias("digest")]


def bag_fingerprint(df: DataFrame, **options) -> DataFrame:
    """One row (rows, digest). Each task sends a single partial sum, whatever the table's size."""
    return df.agg(*digest_columns(df, **options))


def fingerprint(side: Side | Mapping[tuple[str, str], DataFrame], **options) -> DataFrame:
    """(database, table, rows, digest) of every table of a side.

    One plan for a side of usual size; beyond ``TABLES_PER_PLAN`` tables, each further plan's few rows are written first.
    """
    tables = side.tables if isinstance(side, Side) else side
    if len(tables) > TABLES_PER_PLAN:
        names = sorted(tables)
        return union_all(cut_lineage(fingerprint({n: tables[n] for n in names[i:i + TABLES_PER_PLAN]}, **options))
                         for i in range(0, len(names), TABLES_PER_PLAN))
    return union_all([
        bag_fingerprint(df, **options).select(F.lit(db).alias("database"), F.lit(name).alias("table"), "rows", "digest")
        for (db, name), df in sorted(tables.items())], "database string, table string, rows bigint, digest string")


def tree_digest(df: DataFrame, depth: int = TREE_DEPTH, **options) -> DataFrame:
    """One row (rows, digest): a full-strength md5 over the sorted rows, built as a hash tree.

    Concatenating a whole table in order needs one task to hold it. Here equal rows are first counted, each leaf lists
    the distinct row hashes that share ``depth`` leading digits, and each level above lists at most 256 children. The
    depth is fixed, so a digest does not depend on the size of a table; 10**12 rows make leaves of 60,000 hashes.
    """
    if depth < 2 or depth % 2:
        raise ValueError("the depth is an even number of digits")
    counted = df.select(row_md5(df, **options).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    level = (counted.groupBy(F.left("h", F.lit(depth)).alias("node"))
             .agg(F.sum("n").alias("n"),
                  F.md5(F.expr("listagg(concat_ws(':', h, cast(n as string)), '|') within group (order by h)"))
                  .alias("digest")))
    while depth > 0:
        depth -= 2
        level = (level.groupBy(F.left("node", F.lit(depth)).alias("parent"))
                 .agg(F.sum("n").alias("n"),
                      F.md5(F.expr("listagg(concat_ws(':', node, digest), '|') within group (order by node)"))
                      .alias("digest"))
                 .withColumnRenamed("parent", "node"))
    return level.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                     F.coalesce(F.max("digest"), F.lit(EMPTY_DIGEST)).alias("digest"))


def key_bucket(df: DataFrame, keys: Sequence[str], digits: int = 2):
    """A bucket by the leading hex digits of the key's md5: the same for every engine and on both sides."""
    return F.left(row_md5(df, keys), F.lit(digits))


def bucket_fingerprints(df: DataFrame, keys: Sequence[str], digits: int = 2, **options) -> DataFrame:
    """(bucket, rows, digest): finds where two tables differ before any row is compared."""
    return (df.groupBy(key_bucket(df, keys, digits).alias("bucket"))
            .agg(*digest_columns(df, **options)))
