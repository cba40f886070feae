"""Reading a keyed table at any moment from its log of changes, by aggregates and windows over the log.

A log has a row per change: the key, a moment, the new values, and ``deleted``, a SQL condition that says a change deletes its key. ``tie`` orders
changes of one moment. Results are newest-row-per-key aggregates, which combine inside tasks, so a hot key sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableshift.functions.times import DAY, MINUTE, SECOND
from tableshift.operators.mutate import first_per_key
from tableshift.operators.slots import last_before


class NothingThere(LookupError):
    """No version answers the request; an empty frame would hide that."""


def off_the_minute(moment: int) -> int:
    """A moment on a whole minute moves one second back, for platforms that take such a moment for the minute to come."""
    return moment - SECOND if moment % MINUTE == 0 else moment


def _live(rows: DataFrame, deleted: str | None) -> DataFrame:
    return rows if deleted is None else rows.filter(~F.coalesce(F.expr(deleted), F.lit(False)))


def state_as_of(log: DataFrame, keys: Sequence[str], time: str, moment: int, *, tie: Sequence[str] = (), deleted: str | None = None,
                whole_minute_step: bool = False) -> DataFrame:
    """The table's rows at a moment (microseconds): the newest change of each key at or before it, without the keys it deletes.

    Changes without a moment are never seen; a NULL key is a key. A moment before the first change is an error.
    """
    moment = off_the_minute(moment) if whole_minute_step else moment
    first = log.agg(F.min(time)).first()[0]
    if first is None or moment < first:
        raise NothingThere("the moment is before the first change")
    return _live(first_per_key(log.filter(F.col(time) <= moment), keys, [time, *tie], last=True), deleted)


def tagged_moment(tags: DataFrame, tag: str) -> int:
    """The moment (tag, at) that carries a tag; of several the newest."""
    found = tags.filter(F.col("tag") == tag).agg(F.max("at")).first()[0]
    if found is None:
        raise NothingThere(f"nothing is tagged {tag}")
    return found


def state_at_tag(log: DataFrame, keys: Sequence[str], time: str, tags: DataFrame, tag: str, *, tie: Sequence[str] = (),
                 deleted: str | None = None) -> DataFrame:
    """The table's rows at a named moment."""
    return state_as_of(log, keys, time, tagged_moment(tags, tag), tie=tie, deleted=deleted)


def validity(log: DataFrame, keys: Sequence[str], time: str, *, tie: Sequence[str] = (), slot_micros: int | None = None) -> DataFrame:
    """Every change with ``valid_to``, the moment of its key's next change; NULL for the newest. ``tie`` columns are numbers.

    The next change is the one before it in reversed time, so a hot key is cut into slots like in ``last_before``.
    """
    back = log.withColumns({"_back": -F.col(time), **{f"_tie{i}": -F.col(c) for i, c in enumerate(tie)}})
    ties = [f"_tie{i}" for i in range(len(tie))]
    found = last_before(back, keys, "_back", F.col(time), name="valid_to", tie=ties, slot_micros=slot_micros)
    return found.drop("_back", *ties)


def net_changes(log: DataFrame, keys: Sequence[str], time: str, after: int, until: int, *, tie: Sequence[str] = (),
                deleted: str | None = None) -> DataFrame:
    """(…keys, change, old, new): what became of each key between two moments, in one pass over the log.

    ``change`` is insert, update or delete; ``old`` and ``new`` hold the values at both moments, without keys, moment and ``tie``. Keys
    with equal values, and keys that came and went in between, are left out.
    """
    rest = [c for c in log.columns if c not in (*keys, time, *tie)]
    gone = F.lit(False) if deleted is None else F.coalesce(F.expr(deleted), F.lit(False))
    order = F.struct(time, *tie)

    def at(moment: int) -> Column:
        return F.max_by(F.struct(gone.alias("gone"), F.struct(*rest).alias("row")), F.when(F.col(time) <= moment, order))

    def here(side: str) -> Column:  # a key without a change so far is as absent as a deleted one
        return F.when(~F.coalesce(F.col(f"{side}.gone"), F.lit(True)), F.col(f"{side}.row"))

    newest = log.filter(F.col(time) <= until).groupBy(*keys).agg(at(after).alias("a"), at(until).alias("b"))
    both = newest.select(*keys, here("a").alias("old"), here("b").alias("new"))
    change = F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), "delete").otherwise("update")
    return both.filter(~F.col("old").eqNullSafe(F.col("new"))).select(*keys, change.alias("change"), "old", "new")


def within_history(log: DataFrame, keys: Sequence[str], time: str, now: int, days: int = 7, *, tie: Sequence[str] = (),
                   deleted: str | None = None) -> DataFrame:
    """The changes that reading at any moment of the last ``days`` (2 to 30) needs, with ``is_base``: those of the window, and before it
    the newest change of each key unless it deletes it. Older moments can no longer be read.
    """
    if not 2 <= days <= 30:
        raise ValueError("the history window is 2 to 30 days")
    opens = now - days * DAY
    base = _live(first_per_key(log.filter(F.col(time) < opens), keys, [time, *tie], last=True), deleted)
    return base.withColumn("is_base", F.lit(True)).unionByName(log.filter(F.col(time) >= opens).withColumn("is_base", F.lit(False)))
