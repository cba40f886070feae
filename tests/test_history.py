"""Tables read from their log of changes, against a replay of the log."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableshift.functions.times import DAY, MINUTE, SECOND
from tableshift.operators import history

SCHEMA = "k int, at long, ord long, v string, gone boolean"
DELETED = "gone"


def replay(changes, moment):
    """{key: (at, ord, v)} by applying the changes one after the other."""
    state = {}
    for k, at, tie, v, gone in sorted((c for c in changes if c[1] is not None), key=lambda c: (c[1], c[2])):
        if at <= moment:
            if gone:
                state.pop(k, None)
            else:
                state[k] = (at, tie, v)
    return state


def log_of(rng, count=300, keys=12, span=40):
    rows = [(rng.choice([None, *range(keys)]), rng.randrange(span), i, rng.choice("abc"), rng.random() < 0.2) for i in range(count)]
    return [*rows, (3, None, count, "never", False)]


@pytest.fixture(scope="module")
def changes():
    return log_of(random.Random(1))


def state(df):
    return {r.k: (r.at, r.ord, r.v) for r in df.collect()}


def test_state_as_of_every_moment(spark, changes):
    log = spark.createDataFrame(changes, SCHEMA)
    for moment in (0, 1, 17, 39, 1000):
        assert state(history.state_as_of(log, ["k"], "at", moment, tie=["ord"], deleted=DELETED)) == replay(changes, moment)


def test_before_the_first_change_is_an_error(spark, changes):
    log = spark.createDataFrame(changes, SCHEMA)
    with pytest.raises(history.NothingThere, match="before the first"):
        history.state_as_of(log, ["k"], "at", -1)
    with pytest.raises(history.NothingThere):
        history.state_as_of(log.limit(0), ["k"], "at", 5)
    with pytest.raises(history.NothingThere, match="tagged"):
        history.state_at_tag(log, ["k"], "at", spark.createDataFrame([("x", 3)], "tag string, at long"), "y")


def test_named_moments_and_whole_minutes(spark, changes):
    log = spark.createDataFrame(changes, SCHEMA)
    tags = spark.createDataFrame([("x", 3), ("x", 20), ("y", 5)], "tag string, at long")
    assert state(history.state_at_tag(log, ["k"], "at", tags, "x", tie=["ord"], deleted=DELETED)) == replay(changes, 20)
    assert history.off_the_minute(5 * MINUTE) == 5 * MINUTE - SECOND and history.off_the_minute(MINUTE + 1) == MINUTE + 1
    two = spark.createDataFrame([(1, 10 * MINUTE - SECOND, 1, "a", False), (1, 10 * MINUTE, 2, "b", False)], SCHEMA)
    assert history.state_as_of(two, ["k"], "at", 10 * MINUTE, whole_minute_step=True).first().v == "a"
    assert history.state_as_of(two, ["k"], "at", 10 * MINUTE).first().v == "b"


@pytest.mark.parametrize("slot", [None, 7])
def test_validity(spark, changes, slot):
    got = {r.ord: r.valid_to for r in history.validity(spark.createDataFrame(changes, SCHEMA), ["k"], "at", tie=["ord"], slot_micros=slot).collect()}
    want = {}
    for key in {c[0] for c in changes}:
        own = sorted((c for c in changes if c[0] == key and c[1] is not None), key=lambda c: (c[1], c[2]))
        want |= {a[2]: b[1] for a, b in zip(own, own[1:])} | {own[-1][2]: None}
    assert got == want | {len(changes) - 1: None}


def test_net_changes(spark, changes):
    log = spark.createDataFrame(changes, SCHEMA)
    for a, b in ((5, 30), (-5, 39), (12, 12), (30, 5)):
        before, after = replay(changes, min(a, b) if a > b else a), replay(changes, b)
        got = {r.k: (r.change, r.old and r.old.v, r.new and r.new.v) for r in history.net_changes(
            log.drop("gone").withColumn("gone", F.col("ord").isin([c[2] for c in changes if c[4]])), ["k"], "at", a, b, tie=["ord"], deleted=DELETED).collect()}
        want = {}
        for k in before.keys() | after.keys():
            x, y = before.get(k, (0, 0, None))[2], after.get(k, (0, 0, None))[2]
            if x != y:
                want[k] = ("insert" if x is None else "delete" if y is None else "update", x, y)
        assert got == want


def test_the_window_answers_like_the_whole_log(spark):
    rng = random.Random(2)
    rows = [(k, at * DAY // 10, i, v, gone) for i, (k, at, _, v, gone) in enumerate(log_of(rng, 200, 9, 400)[:-1])]
    log, now = spark.createDataFrame(rows, SCHEMA), 40 * DAY
    kept = history.within_history(log, ["k"], "at", now, 7, tie=["ord"], deleted=DELETED).cache()
    assert kept.count() < len(rows) / 2 and kept.filter("is_base and gone").isEmpty()
    for moment in (now - 7 * DAY, now - 3 * DAY, now):
        assert state(history.state_as_of(kept, ["k"], "at", moment, tie=["ord"], deleted=DELETED)) == replay(rows, moment)
    with pytest.raises(ValueError):
        history.within_history(log, ["k"], "at", now, 1)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 6), st.booleans()), max_size=12), st.integers(0, 6))
def test_any_small_log(spark, small, moment):
    rows = [(k, at, i, str(i), gone) for i, (k, at, gone) in enumerate(small)]
    log = spark.createDataFrame(rows, SCHEMA)
    if not rows or moment < min(r[1] for r in rows):
        with pytest.raises(history.NothingThere):
            history.state_as_of(log, ["k"], "at", moment, tie=["ord"], deleted=DELETED)
    else:
        assert state(history.state_as_of(log, ["k"], "at", moment, tie=["ord"], deleted=DELETED)) == replay(rows, moment)
