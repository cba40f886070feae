"""Carrying a branch's own edits onto newer data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableshift.operators.diff import REPEATED_KEY
from tableshift.operators.mutate import insert_if_absent, keyed_update
from tableshift.sources.sides import union_all


def branch_only(branch: DataFrame, production: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Branch rows whose key production lacks. Edits under a shared key are not seen here; ``three_way`` sees them."""
    return branch.join(production.select(*keys).distinct(), list(keys), "left_anti")


def rows_using(rows: DataFrame, column: str, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose column refers to a wanted key."""
    return rows.join(wanted.select(F.col(key).alias(column)).distinct(), column, "left_semi").select(*rows.columns)


def carry_over(target_parents: DataFrame, target_rows: DataFrame, parents: DataFrame, edits: DataFrame, parent_key: str,
               row_key: str) -> tuple[DataFrame, DataFrame]:
    """The target's parent table and rows with the branch's new parents and row edits applied."""
    new_parents = insert_if_absent(target_parents, parents, [parent_key], [parent_key])
    return new_parents, keyed_update(target_rows, edits, [row_key], [row_key])


def three_way(base: DataFrame, branch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Apply what the branch changed since ``base`` to ``target``.

    (…keys, action, conflicts, …columns): ``take`` the branch's edit, ``merge`` edits of different columns, ``keep`` the
    target, ``delete``, ``same``, or ``conflict`` with the columns both sides set to different values (the target's
    values are shown; nothing is picked). All three sides meet in one shuffle on the key, which must not repeat.
    """
    keys = list(keys)
    columns = [c for c in base.columns if c not in keys]

    def side(df, name):
        return df.select(*keys, F.lit(name).alias("side"), F.struct(*columns).alias("row"))
    # Nothing collapses before the shuffle, so rows are spread by key first and sorted once where they meet.
    met = union_all([side(base, "b"), side(branch, "r"), side(target, "t")]).repartition(*keys).groupBy(*keys)

    def only_row(name):
        own = F.when(F.col("side") == name, F.col("row"))
        refused = F.raise_error(F.lit(f"{REPEATED_KEY}: {', '.join(keys)}"))
        return F.when(F.count(own) > 1, refused).otherwise(F.max(own)).alias(name)
    joined = met.agg(*[only_row(name) for name in ("b", "r", "t")])
    b, r, t = F.col("b"), F.col("r"), F.col("t")

    def moved(x, c):
        return ~F.col(f"{x}.{c}").eqNullSafe(F.col(f"b.{c}"))
    clash = [F.when(moved("r", c) & moved("t", c) & ~F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")), c) for c in columns]
    everywhere = b.isNotNull() & r.isNotNull() & t.isNotNull()
    conflicts = (F.when(everywhere, F.concat_ws(",", *clash))
                 .when(b.isNull() & r.isNotNull() & t.isNotNull() & ~r.eqNullSafe(t), "*inserted twice*")
                 .when(b.isNotNull() & r.isNull() & t.isNotNull() & ~t.eqNullSafe(b), "*deleted and edited*")
                 .when(b.isNotNull() & r.isNotNull() & t.isNull() & ~r.eqNullSafe(b), "*edited and deleted*")
                 .otherwise(""))
    joined = joined.withColumn("conflicts", conflicts)
    branch_moved, target_moved = ~r.eqNullSafe(b), ~t.eqNullSafe(b)
    action = (F.when(F.col("conflicts") != "", "conflict")
              .when(r.eqNullSafe(t) & r.isNull(), "gone")
              .when(r.eqNullSafe(t), "same")
              .when(branch_moved & r.isNull(), "delete")
              .when(branch_moved & ~target_moved, "take")
              .when(branch_moved, "merge")
              .when(t.isNull(), "gone").otherwise("keep"))
    joined = joined.withColumn("action", action)

    def merged(c):
        ours, theirs = F.col(f"r.{c}"), F.col(f"t.{c}")
        return (F.when(F.col("action") == "take", ours)
                .when((F.col("action") == "merge") & moved("r", c), ours).otherwise(theirs).alias(c))
    return joined.select(*keys, "action", "conflicts", *[merged(c) for c in columns])


def merged_table(merge: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows to publish after a three-way merge without conflicts."""
    if not merge.filter("action = 'conflict'").isEmpty():
        raise ValueError("the merge has conflicts; resolve them first")
    return merge.filter("action not in ('delete', 'gone')").drop("action", "conflicts")
