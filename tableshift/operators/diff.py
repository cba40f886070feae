"""Row-level differences: by key, and of bags of rows without a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableshift.functions.canon import row_md5
from tableshift.functions.text import any_of
from tableshift.session import counted_step
from tableshift.sources.sides import union_all


REPEATED_KEY = "rows cannot be matched because the key repeats or is NULL"


class NotAKey(ValueError):
    """The columns given as a key do not identify rows."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(…keys, copies) of keys held by more than one row; copies are counted before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def require_key(df: DataFrame, keys: Sequence[str], what: str = "table") -> None:
    if not duplicate_keys(df, keys).isEmpty():
        raise NotAKey(f"{what}: {', '.join(keys)} repeats, so rows cannot be matched; use bag_diff")


def _checked(df: DataFrame, keys: Sequence[str], check_key: bool) -> Column:
    """True, or a failure where the key repeats or is NULL.

    The key is checked where the rows meet anyway: numbering the rows of a key uses the join's own shuffle and sort and
    keeps no rows in memory, so the check needs no extra pass.
    """
    if not check_key:
        return F.lit(True)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    empty = any_of([F.col(k).isNull() for k in keys])
    refused = F.raise_error(F.lit(f"{REPEATED_KEY}: {', '.join(keys)}; use bag_diff")).cast("boolean")
    return F.when((number > 1) | empty, refused).otherwise(True)


# Names that no table is expected to use; values travel in structs, so their names can't clash with anything.
_OLD, _NEW = "#old", "#new"


def _side(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, check_key: bool) -> DataFrame:
    """A side ready to be joined: its keys, and a struct of its values and its presence."""
    values = [F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)]
    return df.select(*keys, F.struct(_checked(df, keys, check_key).alias("here"), *values).alias(name))


def compared_columns(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None) -> list[str]:
    """The columns to compare: those given, or all of both sides, which must then agree in names and types."""
    if columns is not None:
        return list(columns)
    differ = column_differences(old, new)
    if differ:
        raise DifferentColumns(f"compare the schemas first; they differ in {', '.join(differ)}")
    return [c for c in old.columns if c not in keys]


class DifferentColumns(ValueError):
    """The sides of a comparison do not have the same columns."""


def column_differences(old: DataFrame, new: DataFrame) -> list[str]:
    """Columns that only one side has, or that have another type on the other."""
    types = [{f.name: f.dataType for f in df.schema.fields} for df in (old, new)]
    return sorted(c for c in {*types[0], *types[1]} if types[0].get(c) != types[1].get(c))


def aligned(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns of both: NULL where a side lacks one, text where the types differ."""
    differ, sides = set(column_differences(old, new)), (old, new)
    names = [*old.columns, *[c for c in new.columns if c not in old.columns]]
    types = {f.name: f.dataType for df in (new, old) for f in df.schema.fields}

    def cell(df: DataFrame, name: str) -> Column:
        both = name in old.columns and name in new.columns
        value = F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(types[name])
        return (value.cast("string") if name in differ and both else value).alias(name)
    left, right = [df.select(*[cell(df, c) for c in names]) for df in sides]
    return left, right


def row_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, *,
             check_key: bool = True, keep_values: bool = False, include_same: bool = False) -> DataFrame:
    """(…keys, change, changed_columns): added, removed or changed rows, NULL-safe in every column.

    Each side is read and shuffled once. Running it fails if the key repeats or is NULL on a side; it is refused if the
    sides' columns differ, unless ``columns`` says which to compare.
    """
    keys = list(keys)
    columns = compared_columns(old, new, keys, columns)
    joined = _side(old, keys, columns, _OLD, check_key).join(_side(new, keys, columns, _NEW, check_key), keys, "full")
    value = lambda side, i: F.col(f"`{side}`").getField(f"v{i}")
    gone, fresh = F.col(f"`{_NEW}`").isNull(), F.col(f"`{_OLD}`").isNull()
    both = F.col(f"`{_OLD}`").getField("here") & F.col(f"`{_NEW}`").getField("here")
    names = [F.when(both & ~value(_OLD, i).eqNullSafe(value(_NEW, i)), c) for i, c in enumerate(columns)]
    changed = F.concat_ws(",", *names) if names else F.lit("")
    # ``here`` is looked at in every case, since looking at it is what checks the key.
    change = (F.when(fresh & F.col(f"`{_NEW}`").getField("here"), "added").when(gone & F.col(f"`{_OLD}`").getField("here"), "removed")
              .when(both & (changed != ""), "changed").otherwise("same"))
    values = [value(s, i).alias(f"{p}{c}") for i, c in enumerate(columns) for s, p in ((_OLD, "old_"), (_NEW, "new_"))] if keep_values else []
    result = joined.select(*keys, change.alias("change"), changed.alias("changed_columns"), *values)
    return result if include_same else result.filter("change <> 'same'")


def differing_keys(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, *,
                   check_key: bool = True) -> DataFrame:
    """(…keys) of rows that differ or are on one side only. Only keys and a full-strength hash of each row are shuffled."""
    keys = list(keys)
    columns = compared_columns(old, new, keys, columns)

    def hashed(df: DataFrame, name: str) -> DataFrame:
        content = row_md5(df, columns) if columns else F.lit("")
        return df.select(*keys, F.when(_checked(df, keys, check_key), content).alias(name))
    met = hashed(old, _OLD).join(hashed(new, _NEW), keys, "full")
    return met.filter(~F.col(f"`{_OLD}`").eqNullSafe(F.col(f"`{_NEW}`"))).select(*keys)


def pruned_row_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
                    **options) -> DataFrame | None:
    """``row_diff`` that finds the differing keys by row hashes first, and then fetches only those rows.

    None if there is none. The keys are written to the shared folder; few of them are broadcast by Spark, many are joined.
    """
    keys = list(keys)
    columns = compared_columns(old, new, keys, columns)
    suspects, found = counted_step(differing_keys(old, new, keys, columns))
    if not found:
        return None
    old, new = [df.join(suspects, keys, "left_semi") for df in (old, new)]
    return row_diff(old, new, keys, columns, check_key=False, **options)


def changed_column_counts(diff: DataFrame) -> DataFrame:
    """(changed_column, rows) over the changed rows of a row diff."""
    return (diff.filter("change = 'changed'")
            .select(F.explode(F.split("changed_columns", ",")).alias("changed_column"))
            .groupBy("changed_column").agg(F.count(F.lit(1)).alias("rows")))


def bag_diff(old: DataFrame, new: DataFrame, count: str = "delta") -> DataFrame:
    """(…columns, delta): how many more copies of a row the new side has. Equal rows meet once per task and row.

    Refused if the sides' columns differ. ``count`` names the last column; it gets a ``_`` for each clash.
    """
    compared_columns(old, new, [], None)
    while count in old.columns:
        count += "_"
    columns = [f"`{c}`" for c in old.columns]
    sides = union_all([old.withColumn(count, F.lit(-1)), new.select(*columns).withColumn(count, F.lit(1))])
    return sides.groupBy(*columns).agg(F.sum(f"`{count}`").alias(count)).filter(F.col(f"`{count}`") != 0)


def missing_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks. Nothing lost means no rows."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def change_rows(diff: DataFrame, keys: Sequence[str], columns: Sequence[str], version: int | Column) -> DataFrame:
    """(change_type, version, …keys, …columns): a row diff with values as insert, update_pre, update_post and delete rows."""
    def image(kind: str, prefix: str):
        return F.struct(F.lit(kind).alias("change_type"), *[F.col(f"{prefix}{c}").alias(c) for c in columns])
    images = (F.when(F.col("change") == "added", F.array(image("insert", "new_")))
              .when(F.col("change") == "removed", F.array(image("delete", "old_")))
              .when(F.col("change") == "changed", F.array(image("update_pre", "old_"), image("update_post", "new_"))))
    version = version if isinstance(version, Column) else F.lit(version).cast("bigint")
    return (diff.select(*keys, F.explode(images).alias("image"))
            .select("image.change_type", version.alias("version"), *keys, *[f"image.{c}" for c in columns]))
