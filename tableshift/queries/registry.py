"""Registration of queries with their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableshift.sources.fixtures import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    """Register ``fn(tables)`` under its own name."""
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register
