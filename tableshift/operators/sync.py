"""Keeping a copy in step: full refresh, readiness, freshness, late writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableshift.functions.times import SECOND
from tableshift.operators.diff import require_key
from tableshift.operators.slots import choose_slot, last_before, with_groups
from tableshift.sources.versions import VersionStore


def snapshot_sync(source: DataFrame, keys: Sequence[str], target: VersionStore, table: str, committed_at: int,
                  source_version: int) -> int:
    """Replace the target's copy by the whole source, which must have the key; the source's version is kept as the tag."""
    require_key(source, keys, table)
    return target.export({table: source}, committed_at, tag=str(source_version), keep_others=True)


def freshness(newest: DataFrame, synced: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(…keys, newest, synced, lag, current) from the newest (…keys, version) on each side; never synced is not current."""
    joined = (newest.select(*keys, F.col("version").alias("newest"))
              .join(synced.select(*keys, F.col("version").alias("synced")), list(keys), "left"))
    return (joined.withColumn("lag", F.col("newest") - F.coalesce("synced", F.lit(0)))
            .withColumn("current", F.col("newest").eqNullSafe(F.col("synced"))))


def ready(state: Column, rows: Column, expected: int | Column) -> Column:
    return F.contains(state, F.lit("ONLINE")) & (rows >= expected)


def sync_outcome(polls: DataFrame, key: str, time: str, order: str, *, expected_rows: int, timeout_seconds: int,
                 slot_micros: int | None = None) -> DataFrame:
    """(key, outcome, at): how each sync's waiting ended, over polls (key, time, order, state, rows, error).

    A poll that ended in an error counts as 0 rows. The third other error without a good poll in between
    ends it as ``error``; a failed state as ``failed``; enough rows while online as ``ready``; too long as ``timeout``.
    What has not ended is ``waiting``.
    """
    slot_micros = slot_micros or choose_slot(polls, [key], time)
    other = F.col("error") == "other"
    mark = F.when(other, "e").when(F.col("error").isNull(), "g")  # a missing table neither counts nor resets
    marked = polls.withColumn("mark", mark)
    one = last_before(marked, [key], time, F.col("mark"), name="mark1", tie=[order], slot_micros=slot_micros)
    pair = F.when(F.col("mark").isNotNull(), F.concat(F.col("mark"), F.coalesce("mark1", F.lit("-"))))
    two = last_before(one, [key], time, pair, name="mark2", tie=[order], slot_micros=slot_micros)
    # The start of each sync is looked up per (key, slot), the grouping the rows already have, so a hot key stays spread.
    rows_in_slots, group = with_groups(two, [key], time, slot_micros)
    starts = with_groups(polls, [key], time, slot_micros)[0].groupBy(*group).agg(F.min(time).alias("first")).select(
        *group, F.min("first").over(Window.partitionBy(*group[:-1])).alias("started"))
    rows = F.when(F.col("error").isNotNull(), 0).otherwise(F.col("rows"))
    state = F.coalesce("state", F.lit("unknown"))
    outcome = (F.when(other & (F.col("mark2") == "ee"), "error")
               .when(F.contains(state, F.lit("FAILED")), "failed")
               .when(ready(state, rows, expected_rows), "ready")
               .when(F.col(time) - F.col("started") > timeout_seconds * SECOND, "timeout"))
    judged = rows_in_slots.join(starts, group).withColumn("outcome", outcome)
    ended = F.when(F.col("outcome").isNotNull(), F.struct(time, order))
    return (judged.groupBy(key)
            .agg(F.coalesce(F.min_by("outcome", ended), F.lit("waiting")).alias("outcome"), F.min(ended[time]).alias("at")))


def late_writes(df: DataFrame, id_column: str, mark: int | DataFrame) -> DataFrame:
    """Rows past the watermark: writes that reached the old side after the switch. Works on streams with a number."""
    limit = mark.scalar() if isinstance(mark, DataFrame) else F.lit(mark)
    return df.filter(F.col(id_column) > limit)
