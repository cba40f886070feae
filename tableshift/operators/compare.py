"""Comparing two sides: fingerprints, watermarks, sequences, schemas and texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableshift.operators.constraints import Rules
from tableshift.operators.digest import bucket_fingerprints, fingerprint
from tableshift.sources.sides import Side, union_all


def compare_fingerprints(old: DataFrame, new: DataFrame, on: Sequence[str] = ("database", "table")) -> DataFrame:
    """(…on, rows_old, rows_new, identical). A table on one side only is not identical."""
    left = old.select(*on, F.col("rows").alias("rows_old"), F.col("digest").alias("digest_old"))
    right = new.select(*on, F.col("rows").alias("rows_new"), F.col("digest").alias("digest_new"))
    same = F.col("rows_old").eqNullSafe(F.col("rows_new")) & F.col("digest_old").eqNullSafe(F.col("digest_new"))
    return left.join(right, list(on), "full").select(*on, "rows_old", "rows_new", same.alias("identical"))


def copy_compare(old: Side, new: Side, **options) -> DataFrame:
    """Per table: row counts on both sides and whether the contents are identical."""
    return compare_fingerprints(fingerprint(old, **options), fingerprint(new, **options))


def bucket_compare(old: DataFrame, new: DataFrame, keys: Sequence[str], digits: int = 2, **options) -> DataFrame:
    """(bucket, rows_old, rows_new, identical) over buckets of the key."""
    return compare_fingerprints(bucket_fingerprints(old, keys, digits, **options),
                                bucket_fingerprints(new, keys, digits, **options), on=("bucket",))


def watermark(df: DataFrame, id_column: str) -> DataFrame:
    """One row (newest, rows)."""
    return df.agg(F.max(id_column).alias("newest"), F.count(F.lit(1)).alias("rows"))


def watermark_compare(old: Mapping[str, tuple[DataFrame, str]], new: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table, newest_old, rows_old, newest_new, rows_new, matches): the pair must be equal on both sides."""
    def marks(side, suffix):
        return union_all([watermark(df, key).select(F.lit(name).alias("table"), F.col("newest").alias(f"newest_{suffix}"),
                                                   F.col("rows").alias(f"rows_{suffix}"))
                          for name, (df, key) in sorted(side.items())],
                         f"table string, newest_{suffix} bigint, rows_{suffix} bigint")
    joined = marks(old, "old").join(marks(new, "new"), "table", "full")
    return joined.withColumn("matches", F.col("newest_old").eqNullSafe(F.col("newest_new"))
                             & F.col("rows_old").eqNullSafe(F.col("rows_new")))


def sequence_compare(old: DataFrame, new: DataFrame, mode: str = "equal") -> DataFrame:
    """Old (sequence, last_value) against new (sequence, last_value, newest_id).

    ``ok`` needs the values equal, or with ``at_or_past`` the new value not behind; ``covers_ids`` says the next id is
    free; ``reset_to`` is the value to restart from when the sequence values were not copied.
    """
    joined = (old.select("sequence", F.col("last_value").alias("last_value_old"))
              .join(new.select("sequence", F.col("last_value").alias("last_value_new"), "newest_id"), "sequence", "full"))
    past, now = F.col("last_value_old"), F.col("last_value_new")
    ok = now.eqNullSafe(past) if mode == "equal" else F.coalesce(now >= past, past.isNull())
    return (joined.withColumn("ok", ok)
            .withColumn("covers_ids", F.coalesce(F.col("newest_id") <= now, F.col("newest_id").isNull()))
            .withColumn("reset_to", F.coalesce("newest_id", F.lit(0)) + 1))


def all_true(condition: Column, strict: bool = True) -> Column:
    """Whether every row holds. Nothing to check fails when strict and passes otherwise; an unknown counts as false."""
    return F.coalesce(F.bool_and(F.coalesce(condition, F.lit(False))), F.lit(not strict))


SCHEMA_ROWS = "table string, position int, column string, type string, nulls bigint"


CELLS = "array<struct<position: int, column: string, type: string, nulls: bigint>>"


def column_cells(df: DataFrame) -> Column:
    """The columns of a table and the NULLs each holds, as one aggregate of type ``CELLS``."""
    return F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                              F.count_if(F.col(f"`{f.name}`").isNull()).alias("nulls")) for i, f in enumerate(df.schema.fields)])


def schema_rows(side: Mapping[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, nulls): a table's definition with the NULLs it really holds.

    Parquet keeps no constraints, so NOT NULL is observed: one aggregate per table counts every column's NULLs.
    """
    frames = []
    for name, df in sorted(side.items()):
        frames.append(df.agg(column_cells(df).alias("cells")).select(F.lit(name).alias("table"), F.inline("cells")))
    return union_all(frames, SCHEMA_ROWS)


def declared_schema_rows(spark, side: Mapping[str, T.StructType]) -> DataFrame:
    """The same from declared types alone, for sides that hold no data yet."""
    rows = [(name, i, f.name, f.dataType.simpleString(), None) for name, schema in sorted(side.items())
            for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, SCHEMA_ROWS)


def declared_rules(spark, side: Mapping[str, T.StructType], rules: Mapping[str, Rules]) -> DataFrame:
    """(table, kind, name, definition) of what a side declares: columns with type and nullability, keys, checks, foreign keys.

    A primary key's columns are not nullable, whatever else is said. No data is read.
    """
    found = []
    for table, schema in side.items():
        own = rules.get(table, Rules())
        filled = {*own.not_null, *own.primary_key}
        found += [(table, "column", f.name, f.dataType.simpleString() + ("" if f.nullable and f.name not in filled else " not null"))
                  for f in schema.fields]
        if own.primary_key:
            found.append((table, "primary key", "primary key", ", ".join(own.primary_key)))
        found += [(table, "unique", ", ".join(u), ", ".join(u)) for u in own.unique]
        found += [(table, "check", name, str(condition)) for name, condition in own.checks.items()]
        found += [(table, "foreign key", ", ".join(k.columns), f"{k.parent} ({', '.join(k.parent_columns)})") for k in own.foreign_keys]
    return spark.createDataFrame(sorted(found), "table string, kind string, name string, definition string")


def declared_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(table, kind, name, definition_old, definition_new, status) of two sides' ``declared_rules``: same, changed, missing, added."""
    key = ["table", "kind", "name"]
    joined = (old.withColumnRenamed("definition", "definition_old")
              .join(new.withColumnRenamed("definition", "definition_new"), key, "full"))
    status = (F.when(F.col("definition_new").isNull(), "missing").when(F.col("definition_old").isNull(), "added")
              .when(F.col("definition_old") != F.col("definition_new"), "changed").otherwise("same"))
    return joined.withColumn("status", status)


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Column by column: missing, added, moved, retyped, different nullability, or same."""
    def renamed(df, suffix):
        return df.select("table", "column", *[F.col(c).alias(f"{c}_{suffix}") for c in ("position", "type", "nulls")])
    joined = renamed(old, "old").join(renamed(new, "new"), ["table", "column"], "full")
    status = (F.when(F.col("position_new").isNull(), "missing")
              .when(F.col("position_old").isNull(), "added")
              .when(F.col("type_old") != F.col("type_new"), "retyped")
              .when(F.col("position_old") != F.col("position_new"), "moved")
              .when((F.col("nulls_old") == 0) != (F.col("nulls_new") == 0), "nullability")
              .otherwise("same"))
    return joined.withColumn("status", status)


def text_diff(old_lines: DataFrame, new_lines: DataFrame) -> DataFrame:
    """(file, lines_old, lines_new, differing, first_difference, identical) of two sets of numbered lines.

    Lines meet on (file, position), so even one huge file spreads over many tasks.
    """
    left = old_lines.select("file", "position", F.col("line").alias("line_old"))
    right = new_lines.select("file", "position", F.col("line").alias("line_new"))
    joined = left.join(right, ["file", "position"], "full")
    differs = ~F.col("line_old").eqNullSafe(F.col("line_new"))
    return (joined.groupBy("file")
            .agg(F.count("line_old").alias("lines_old"), F.count("line_new").alias("lines_new"),
                 F.count_if(differs).alias("differing"),
                 F.min(F.when(differs, F.col("position"))).cast("bigint").alias("first_difference"))
            .withColumn("identical", F.col("differing") == 0))


def ledger_compare(actual: DataFrame, expected: DataFrame, keys: Sequence[str] = ("database", "version")) -> DataFrame:
    """(…keys, state): applied as expected, missing, or unexpected."""
    a = actual.select(*keys).distinct().withColumn("applied", F.lit(True))
    e = expected.select(*keys).distinct().withColumn("expected", F.lit(True))
    state = (F.when(F.col("applied") & F.col("expected"), "applied")
             .when(F.col("expected"), "missing").otherwise("unexpected"))
    return a.join(e, list(keys), "full").select(*keys, state.alias("state"))
