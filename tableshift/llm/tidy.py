"""Keeping the disks and the memory of the executors clear in jobs of many steps."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, a finished query's shuffle files go at once, not when the driver happens to collect its garbage.

    For steps whose results are written tables: nothing reads the shuffles again. The session's own setting comes back
    at the end.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def batches_of_texts(spark: SparkSession, most: int = 2048) -> None:
    """From now on the session hands at most ``most`` rows at a time to Python, unless it is set to fewer.

    A batch is held by the JVM and by Python at once, and rows with whole texts are long. The plan of a returned frame is made when it runs, so
    the setting stays.
    """
    if not 0 < int(spark.conf.get(_BATCH)) <= most:
        spark.conf.set(_BATCH, str(most))
