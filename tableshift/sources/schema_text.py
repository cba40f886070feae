"""Schema files as numbered lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableshift.functions.text import starts_with_any

# Lines a schema dump adds itself and that say nothing about the schema.
NOISE_PREFIXES = ("--", "\\restrict", "\\unrestrict", "SET ", "SELECT pg_catalog.")


def read_schema_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, text): one row per file."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text")))


def schema_lines(files: DataFrame, file: str = "file", text: str = "text",
                 noise: Sequence[str] = NOISE_PREFIXES) -> DataFrame:
    """(file, position, line): meaningful lines only, numbered after filtering.

    The filter runs inside the array, so a file is split, cleaned and numbered without a shuffle.
    """
    lines = F.filter(F.split(F.col(text), "\r\n|\n|\r"),
                     lambda line: (F.trim(line) != "") & ~starts_with_any(line, noise))
    return files.select(F.col(file).alias("file"), F.posexplode(lines).alias("position", "line"))
