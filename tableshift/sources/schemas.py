"""Catalog schemas that belong to a job: created with its label, and dropped only if they carry it."""

from __future__ import annotations

from pyspark.sql import SparkSession

LABEL = "tableshift.owner"


def _label_of(spark: SparkSession, schema: str) -> str | None:
    rows = spark.sql(f"DESCRIBE SCHEMA EXTENDED `{schema}`").filter("info_name = 'Properties'").collect()  # one row
    return next((part for r in rows for part in [r["info_value"]] if part), None)


def create_own_schema(spark: SparkSession, schema: str, label: str) -> bool:
    """Create the schema unless it is there; True if this call made it."""
    if spark.catalog.databaseExists(schema):
        return False
    spark.sql(f"CREATE SCHEMA `{schema}` WITH DBPROPERTIES ('{LABEL}' = '{label}')")
    return True


def drop_own_schema(spark: SparkSession, schema: str, label: str) -> bool:
    """Drop the schema with everything in it, if it carries the label; a stranger's schema stays and gives False."""
    if not spark.catalog.databaseExists(schema) or f"({LABEL},{label})" not in (_label_of(spark, schema) or ""):
        return False
    spark.sql(f"DROP SCHEMA `{schema}` CASCADE")
    return True
