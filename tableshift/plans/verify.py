"""Proving a copy: fingerprints first, then row hashes, then the rows that differ; and the gate before a switch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableshift.functions.text import any_of
from tableshift.operators.checks import gate
from tableshift.operators.compare import CELLS, column_cells, compare_fingerprints, schema_diff
from tableshift.operators.diff import aligned, pruned_row_diff
from tableshift.operators.digest import digest_columns
from tableshift.session import cut_lineage
from tableshift.sources.sides import Side, union_all


def drill_down(old: Side, new: Side, keys: Mapping[tuple[str, str], Sequence[str]]) -> dict[tuple[str, str], DataFrame]:
    """Row diffs of the keyed tables on both sides that differ.

    Row hashes say whether a table differs at all and where, so only differing rows are fetched. A table of one side only has all its
    rows removed or added. Where the sides' columns differ, a column of one side only counts as NULL on the other, and
    retyped columns are compared as text; ``schema_diff`` names such columns.
    """
    diffs = {}
    for name in sorted(keys):
        one = old.tables.get(name, new.tables.get(name))
        if one is not None:
            left, right = aligned(old.tables.get(name, one.limit(0)), new.tables.get(name, one.limit(0)))
            diffs[name] = pruned_row_diff(left, right, keys[name])
    return {name: df for name, df in diffs.items() if df is not None}


def side_profile(side: Side, newest: Mapping[tuple[str, str], str]) -> DataFrame:
    """(database, table, rows, digest, newest, cells) of every table, one scan each: fingerprint, largest id as text, and the
    columns with the NULLs they hold. Written, so that any number of checks read a row per table.
    """
    def one(name: tuple[str, str], df: DataFrame) -> DataFrame:
        mark = F.max(newest[name]).cast("string") if name in newest else F.lit(None).cast("string")
        return df.agg(*digest_columns(df), mark.alias("newest"), column_cells(df).alias("cells")).select(
            F.lit(name[0]).alias("database"), F.lit(name[1]).alias("table"), "rows", "digest", "newest", "cells")
    return cut_lineage(union_all([one(n, df) for n, df in sorted(side.tables.items())],
                                 f"database string, table string, rows bigint, digest string, newest string, cells {CELLS}"))


def cutover_gate(old: Side, new: Side, *, watermarks: Mapping[tuple[str, str], str], sequences: DataFrame,
                 ledger_newest: DataFrame, expected_version: int, access: DataFrame, sync: DataFrame | None,
                 smoke: DataFrame, declarations: DataFrame | None = None) -> DataFrame:
    """(check, passed): the seven conditions of a switch. All must hold.

    An unused sync passes. Schema and contents are one check: a copy with other columns is not the same table, nor is one with
    other keys or rules (``declarations``, a ``declared_diff``). Contents, schemas and watermarks need one scan per table and side.
    """
    before, after = side_profile(old, watermarks), side_profile(new, watermarks)
    schema = schema_diff(*[p.select(F.concat_ws(".", "database", "table").alias("table"), F.inline("cells")) for p in (before, after)])
    contents = (compare_fingerprints(before, after).select("identical")
                .unionByName(schema.select((F.col("status") == "same").alias("identical"))))
    if declarations is not None:
        contents = contents.unionByName(declarations.select((F.col("status") == "same").alias("identical")))
    key = ["database", "table"]
    marks = (before.select(*key, F.col("newest").alias("newest_old"), F.col("rows").alias("rows_old"))
             .join(after.select(*key, "newest", "rows"), key, "left")
             .filter(any_of([(F.col("database") == d) & (F.col("table") == t) for d, t in watermarks]))
             .select((F.col("newest_old").eqNullSafe(F.col("newest")) & F.col("rows_old").eqNullSafe(F.col("rows"))).alias("matches")))
    unused = ledger_newest.sparkSession.range(1).select(F.lit(True).alias("ok"))
    return gate({
        "schema and tables identical": contents,
        "watermark matches": marks.select("matches"),
        "sequences carried over": sequences.select("ok"),
        "migration history carried over": ledger_newest.toDF("newest").select(
            F.coalesce(F.col("newest") == expected_version, F.lit(False))),
        "reader can read every table": access.select("can_read"),
        "sync current or unused": unused if sync is None else sync.select("current"),
        "smoke test": smoke.select("smoke_ok"),
    })
