"""Moments are whole microseconds or seconds since 1970; "now" is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR
DEFAULT_TTL_SECONDS = 86_400
HISTORY_DAYS = 7
HISTORY_DAYS_RANGE = (2, 30)


def off_whole_minute(seconds: Column) -> Column:
    """A moment on a whole minute moves one second earlier."""
    return F.when(seconds % 60 == 0, seconds - 1).otherwise(seconds)


def elapsed_seconds(start_micros: Column, end_micros: Column, places: int = 1) -> Column:
    return F.round((end_micros - start_micros) / float(SECOND), places)
