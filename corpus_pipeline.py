"""Stages that turn raw documents into training sequences. Each takes (spark, docs, sf_dir); each result is written as Parquet
in the shared folder and read again as the next stage's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableshift.llm.stages import STAGES as _STAGES
from tableshift.session import work_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = list(_STAGES)

#: Tokenizers, a classifier and shingle sets are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = work_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
