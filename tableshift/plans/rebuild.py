"""Rebuilding a branch from newer production, and whether tables can be kept current by row replication.

A rebuilt branch starts as production is now. What the old branch had of its own comes back in two ways: tables that only it had are
loaded whole, and its edits to shared tables are applied row by row, by comparing base, branch and production. Nothing of the branch's is
applied where production changed the same values; such rows are reported.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableshift.functions.text import any_of
from tableshift.operators.diff import column_differences
from tableshift.operators.reconcile import three_way
from tableshift.session import cut_lineage
from tableshift.sources.sides import Side, union_all

EDITS = ("take", "merge", "delete", "conflict")
PLAN = "database string, table string, action string, rows bigint, " + ", ".join(f"{e} bigint" for e in EDITS)


def _evolved(base: Side, branch: Side, production: Side) -> set[tuple[str, str]]:
    """Shared tables whose columns differ between the sides: a branch's migrations run before its rows come back."""
    shared = [n for n in base.tables if n in branch.tables and n in production.tables]
    return {n for n in shared if any(column_differences(base.tables[n], s.tables[n]) for s in (branch, production))}


def _merges(base: Side, branch: Side, production: Side, keys: Mapping[tuple[str, str], Sequence[str]]) -> dict[tuple[str, str], DataFrame]:
    """The three-way comparisons of the keyed tables that all three sides have with the same columns, written."""
    evolved = _evolved(base, branch, production)
    shared = [n for n in sorted(keys) if n not in evolved and all(n in s.tables for s in (base, branch, production))]
    return {n: cut_lineage(three_way(base.tables[n], branch.tables[n].select(*base.tables[n].columns),
                                     production.tables[n].select(*base.tables[n].columns), keys[n])) for n in shared}


def _planned(merges: Mapping[tuple[str, str], DataFrame], base: Side, branch: Side, production: Side) -> DataFrame:
    frames, evolved = [], _evolved(base, branch, production)
    for (database, table), df in merges.items():
        counts = [F.count_if(F.col("action") == e).alias(e) for e in EDITS]
        edits = F.col("take") + F.col("merge") + F.col("delete")
        action = F.when(F.col("conflict") > 0, "resolve").when(edits > 0, "apply edits").otherwise("keep")
        frames.append(df.agg(F.count_if(F.col("action") != "gone").alias("rows"), *counts).select(
            F.lit(database).alias("database"), F.lit(table).alias("table"), action.alias("action"), "rows", *EDITS))
    for name in sorted({*branch.tables, *base.tables, *production.tables} - merges.keys()):
        if name not in base.tables and name in branch.tables:
            what = "load" if name not in production.tables else "resolve"
        elif name in base.tables and name not in branch.tables:
            what = "dropped on the branch"
        elif name not in production.tables:
            what = "dropped in production"
        elif name not in branch.tables:
            what = "new in production"
        else:
            what = "columns differ" if name in evolved else "no key"
        counted = branch.tables.get(name, production.tables.get(name, base.tables.get(name))).agg(F.count(F.lit(1)).alias("rows"))
        frames.append(counted.select(F.lit(name[0]).alias("database"), F.lit(name[1]).alias("table"), F.lit(what).alias("action"), "rows",
                                     *[F.lit(0).cast("bigint").alias(e) for e in EDITS]))
    return union_all(frames, PLAN)


def rebuild_plan(base: Side, branch: Side, production: Side, keys: Mapping[tuple[str, str], Sequence[str]]) -> DataFrame:
    """(database, table, action, rows, take, merge, delete, conflict) per table of any side.

    ``base`` is production as it was when the branch was made. Actions: ``load`` a table only the branch has, ``apply edits``, ``resolve``
    conflicts first (or a table both made), ``keep`` production's, ``no key`` for a shared table without one in ``keys``, ``columns differ`` where
    migrations must run first, and what was dropped or is new on one side. A table's three versions meet in one shuffle.
    """
    return _planned(_merges(base, branch, production, keys), base, branch, production)


def rebuilt(base: Side, branch: Side, production: Side, keys: Mapping[tuple[str, str], Sequence[str]], keep_conflicts: bool = False) -> Side:
    """The rebuilt branch: production with the branch's own tables, and its edits of the tables that ``keys`` names.

    Refused where a table's columns differ, and with conflicts, unless production's values are to stay.
    """
    evolved = sorted(".".join(n) for n in _evolved(base, branch, production) if n in keys)
    if evolved:
        raise ValueError(f"run the migrations first: the columns of {', '.join(evolved)} differ")
    merges = _merges(base, branch, production, keys)
    if not keep_conflicts:
        clashing = [".".join(n) for n, df in merges.items() if not df.filter("action = 'conflict'").isEmpty()]
        if clashing:
            raise ValueError(f"edits of {', '.join(clashing)} conflict with production; resolve them first")
    tables = dict(production.tables)
    for name, df in merges.items():
        now, kept = production.tables[name], df.filter("action not in ('delete', 'gone')")
        tables[name] = _conflicts_as_production(kept, now, keys[name]) if keep_conflicts else kept.select(*now.columns)
    own = {n: df for n, df in branch.tables.items() if n not in base.tables and n not in production.tables}
    return Side(branch.name, {**tables, **own})


def _conflicts_as_production(kept: DataFrame, now: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merged rows, and production's own ones where there is a conflict, which may be none."""
    keys = list(keys)
    clashing = kept.filter("action = 'conflict'").select(*keys)
    return kept.filter("action <> 'conflict'").select(*now.columns).unionByName(now.join(clashing, keys, "left_semi"))


def replication_readiness(source: Side, target: Side, keys: Mapping[tuple[str, str], Sequence[str]]) -> DataFrame:
    """(database, table, rows, surplus, empty_keys, target_rows, problem) of every source table: can row replication keep it current?

    Rows are copied, not schema: the target table must exist, with the same columns, and be empty when replication starts; and the
    table needs a key, whose values are present and do not repeat. ``problem`` is the first that applies, else ``none``. Rows are counted per
    key inside tasks first.
    """
    frames = []
    for name, df in sorted(source.tables.items()):
        database, table = name
        there = target.tables.get(name)
        if name in keys:
            counted = df.groupBy(*keys[name]).agg(F.count(F.lit(1)).alias("n"))
            empty = any_of([F.col(k).isNull() for k in keys[name]])
            held = F.sum(F.when(~empty, F.col("n") - 1))
            found = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(held, F.lit(0)).alias("surplus"),
                                F.coalesce(F.sum(F.when(empty, F.col("n"))), F.lit(0)).alias("empty_keys"))
        else:
            nothing = F.lit(None).cast("bigint")
            found = df.agg(F.count(F.lit(1)).alias("rows")).select("rows", nothing.alias("surplus"), nothing.alias("empty_keys"))
        filled = F.lit(None).cast("bigint") if there is None else there.agg(F.count(F.lit(1))).scalar()
        found = found.withColumn("target_rows", filled)
        problem = (F.when(F.lit(there is None), "no target table")
                   .when(F.lit(there is not None and bool(column_differences(df, there))), "columns differ")
                   .when(F.col("target_rows") > 0, "target is not empty")
                   .when(F.lit(name not in keys), "no key")
                   .when(F.col("empty_keys") > 0, "key is empty").when(F.col("surplus") > 0, "key repeats").otherwise("none"))
        frames.append(found.select(F.lit(database).alias("database"), F.lit(table).alias("table"), "rows", "surplus", "empty_keys",
                                   "target_rows", problem.alias("problem")))
    return union_all(frames, "database string, table string, rows bigint, surplus bigint, empty_keys bigint, target_rows bigint, problem string")
