"""Declared constraints as validation jobs. Columnar files enforce none, so violations are counted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableshift.operators.diff import duplicate_keys
from tableshift.sources.sides import union_all


@dataclass(frozen=True)
class ForeignKey:
    columns: Sequence[str]
    parent: str
    parent_columns: Sequence[str]


@dataclass(frozen=True)
class Rules:
    """What a table promises. Checks are SQL conditions by name."""

    not_null: Sequence[str] = ()
    checks: Mapping[str, str] = field(default_factory=dict)
    primary_key: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    foreign_keys: Sequence[ForeignKey] = ()


def _row_rules(df: DataFrame, rules: Rules) -> DataFrame | None:
    """NOT NULL and CHECK rules of a table in one scan. A CHECK on NULL passes, as SQL says."""
    required = list(dict.fromkeys([*rules.not_null, *rules.primary_key]))
    found = [("not_null", c, F.count_if(F.col(c).isNull())) for c in required]
    found += [("check", name, F.count_if(~F.coalesce(F.expr(sql), F.lit(True)))) for name, sql in rules.checks.items()]
    if not found:
        return None
    cells = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("rule"), v.alias("violations"))
                      for k, n, v in found])
    return df.agg(cells.alias("cells")).select(F.inline("cells"))


def _unique_rule(df: DataFrame, kind: str, keys: Sequence[str]) -> DataFrame:
    """Surplus rows per repeated key; a key with a NULL part never repeats."""
    whole = df.dropna(subset=list(keys))
    surplus = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint")
    return duplicate_keys(whole, keys).agg(surplus.alias("violations")).select(
        F.lit(kind).alias("kind"), F.lit(",".join(keys)).alias("rule"), "violations")


def orphans(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    """(…columns, rows) of child keys without a parent. Child rows are counted per key first, so a hot key is one row."""
    counted = child.dropna(subset=list(fk.columns)).groupBy(*fk.columns).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(*[F.col(p).alias(c) for c, p in zip(fk.columns, fk.parent_columns)])
    return counted.join(known, list(fk.columns), "left_anti")


def _foreign_rule(child: DataFrame, parent: DataFrame, fk: ForeignKey) -> DataFrame:
    broken = F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint")
    return orphans(child, parent, fk).agg(broken.alias("violations")).select(
        F.lit("foreign_key").alias("kind"), F.lit(f"{','.join(fk.columns)}->{fk.parent}").alias("rule"), "violations")


def constraint_report(tables: Mapping[str, DataFrame], rules: Mapping[str, Rules]) -> DataFrame:
    """(table, kind, rule, violations) of every declared rule."""
    frames = []
    for name, r in sorted(rules.items()):
        df = tables[name]
        parts = [_row_rules(df, r)]
        if r.primary_key:
            parts.append(_unique_rule(df, "primary_key", r.primary_key))
        parts += [_unique_rule(df, "unique", keys) for keys in r.unique]
        parts += [_foreign_rule(df, tables[fk.parent], fk) for fk in r.foreign_keys]
        frames += [p.select(F.lit(name).alias("table"), "kind", "rule", "violations") for p in parts if p is not None]
    return union_all(frames, "table string, kind string, rule string, violations bigint")
