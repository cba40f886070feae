"""Looking back along time without gathering a key's whole history in one task.

A window over a key puts all its rows in one place, which fails when one key holds a third of the data. Here time is cut
into slots: a window looks back inside (key, slot) only, and what it needs from before the slot is carried over from one
summary row per (key, slot).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableshift.functions.times import DAY, HOUR, MINUTE, SECOND


SLOT_WIDTHS = (DAY, HOUR, MINUTE, SECOND)
SLOT_ROWS = 4_000_000


def choose_slot(df: DataFrame, keys: Sequence[str], time: str, most_rows: int = SLOT_ROWS,
                widths: Sequence[int] = SLOT_WIDTHS) -> int:
    """The widest slot in which no key has more than ``most_rows`` rows, else the narrowest.

    Counting combines inside tasks, and only one number per width reaches the driver; most data needs one pass.
    """
    for width in sorted(widths, reverse=True):
        counted, group = with_groups(df, keys, time, width)
        densest = counted.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if (densest or 0) <= most_rows:
            return width
    return min(widths)


def with_groups(df: DataFrame, keys: Sequence[str], time: str, slot_micros: int) -> tuple[DataFrame, list[str]]:
    """Add the columns that name a row's (key, slot), and return their names; the last is the slot.

    They are never NULL, so rows with a NULL key or moment keep a group of their own and survive a join on it: a filler
    takes the place of a NULL and ``_nulls`` says where. Plain columns sort and hash faster than a struct of them.
    """
    columns, flags = {}, []
    for i, key in enumerate(keys):
        kind = df.schema[key].dataType
        number = isinstance(kind, T.NumericType)
        value = F.col(key) if number or isinstance(kind, T.StringType) else F.col(key).cast("string")
        columns[f"_key{i}"] = F.coalesce(value, F.lit(0).cast(kind) if number else F.lit(""))
        flags.append(F.when(F.col(key).isNull(), 1 << i).otherwise(0))
    at = F.col(time)
    flags.append(F.when(at.isNull(), 1 << len(keys)).otherwise(0))
    columns["_nulls"] = sum(flags[1:], flags[0])
    columns["_slot"] = F.coalesce(at - F.pmod(at, F.lit(slot_micros)), F.lit(0))
    return df.withColumns(columns), list(columns)


def last_before(df: DataFrame, keys: Sequence[str], time: str, value: Column, *, name: str,
                tie: Sequence[str] = (), slot_micros: int | None = None) -> DataFrame:
    """Add ``name``: the newest non-NULL ``value`` strictly before each row of its key, in (time, tie) order.

    A row without a moment is before and after nothing: it gets NULL, and stays where it is, so many of them never meet in
    one task. The slot width is measured unless given.
    """
    keys = list(keys)
    timeless = df.filter(F.col(time).isNull())
    df = df.filter(F.col(time).isNotNull())
    slot_micros = slot_micros or choose_slot(df, keys, time)
    order = [time, *tie]
    cut, group = with_groups(df.withColumn("_value", value), keys, time, slot_micros)
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    near = cut.withColumn("_near", F.last("_value", ignorenulls=True).over(inside))

    # A NULL ordering never wins, so a slot without a value carries NULL but is still listed.
    rank = F.struct(*order) if tie else F.col(time)
    summary = cut.groupBy(*group).agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), rank)).alias("_carry"))
    earlier = Window.partitionBy(*group[:-1]).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(*group, F.last("_carry", ignorenulls=True).over(earlier).alias("_far"))
    found = near.join(carried, group).withColumn(name, F.coalesce("_near", "_far")).drop(*group, "_value", "_near", "_far")
    return found.unionByName(timeless.withColumn(name, F.lit(None).cast(found.schema[name].dataType)))


def write_gaps(df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[str] = (), slot_micros: int | None = None) -> DataFrame:
    """Add ``gap_micros``: time since the key's previous write; NULL for its first."""
    found = last_before(df, keys, time, F.col(time), name="_previous", tie=tie, slot_micros=slot_micros)
    return found.withColumn("gap_micros", F.col(time) - F.col("_previous")).drop("_previous")


def as_of_version(moments: DataFrame, versions: DataFrame, keys: Sequence[str], time: str, version: str, *,
                  slot_micros: int | None = None) -> DataFrame:
    """Each moment with the newest version of its key committed at or before it; NULL before the first.

    ``versions`` has (…keys, time, version). A version committed at the very moment counts.
    """
    columns = moments.columns
    as_moment = moments.withColumn(version, F.lit(None).cast(versions.schema[version].dataType)).withColumn("_late", F.lit(1))
    blank = {c: F.lit(None).cast(moments.schema[c].dataType).alias(c) for c in columns}
    as_version = versions.filter(F.col(time).isNotNull()).select(*[F.col(c) if c in (*keys, time) else blank[c] for c in columns], version,
                                 F.lit(0).alias("_late"))
    line = as_moment.unionByName(as_version)
    found = last_before(line, keys, time, F.col(version), name="_found", tie=["_late", version], slot_micros=slot_micros)
    return found.filter("_late = 1").select(*columns, F.col("_found").alias(version))


def pause_length(df: DataFrame, keys: Sequence[str], time: str, pause_start: int) -> DataFrame:
    """(…keys, last_before, first_after, pause_micros) around the start of a pause."""
    at = F.col(time)
    return (df.groupBy(*keys)
            .agg(F.max(F.when(at <= pause_start, at)).alias("last_before"),
                 F.min(F.when(at > pause_start, at)).alias("first_after"))
            .withColumn("pause_micros", F.col("first_after") - F.col("last_before")))
