"""Runs a registered query and its SQL and compares them the way the driver does: names, row count, values."""

from __future__ import annotations

import math

import duckdb

from tableshift.sources.fixtures import TABLES


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None if they agree, else what differs."""
    names = df.columns
    got = rows_of(names, df.collect())
    result = con.execute(sql)
    expected_names = [d[0] for d in result.description]
    expected = rows_of(expected_names, result.fetchall())
    if sorted(names) != sorted(expected_names):
        return f"columns {sorted(names)} against {sorted(expected_names)}"
    if len(got) != len(expected):
        return f"{len(got)} rows against {len(expected)}"
    for a, b in zip(got, expected):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} against {b}"
    return None if got else "both empty"


# Types that hold the same values in both engines.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def type_differences(df, con, sql: str) -> dict:
    spark_types = {f.name: TYPES.get(f.dataType.simpleString()) for f in df.schema.fields}
    sql_types = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    return {c: (t, sql_types.get(c)) for c, t in spark_types.items() if t != sql_types.get(c)}
