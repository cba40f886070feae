"""A branch rebuilt from newer production, and readiness for row replication."""

import random

import pytest

from tableshift.plans import rebuild
from tableshift.sources.sides import Side

SCHEMA = "k int, a string, b string"
T = ("app", "orders")


def sides(spark, base, branch, now, schema=SCHEMA):
    return [Side(n, {T: spark.createDataFrame(list(rows), schema)}) for n, rows in (("base", base), ("branch", branch), ("now", now))]


def merged(base, branch, now):
    """{key: (a, b)} with the branch's edits on production, and the number of conflicts, where production's values stay."""
    out, conflicts = {}, 0
    for k in {*base, *branch, *now}:
        x, r, n = base.get(k), branch.get(k), now.get(k)
        if r == n or r == x:
            value = n
        elif n == x:
            value = r
        elif x is None or r is None or n is None:
            value, conflicts = n, conflicts + 1
        else:
            cells = [(rc if nc == xc or rc == nc else nc if rc == xc else None) for xc, rc, nc in zip(x, r, n)]
            value = n if None in cells else tuple(cells)
            conflicts += None in cells
        if value is not None:
            out[k] = value
    return out, conflicts


def test_rebuilt_against_a_merge_by_hand(spark):
    rng = random.Random(3)
    base = {k: (rng.choice("xyz"), rng.choice("xyz")) for k in range(60)}

    def edited(seed):
        r = random.Random(seed)
        own = {k: ((r.choice("xyz"), v[1]) if r.random() < 0.4 else (v[0], r.choice("xyz")) if r.random() < 0.6 else v) for k, v in base.items()
               if r.random() > 0.1}
        return own | {100 + r.randrange(12): ("new", r.choice("xy")) for _ in range(6)}
    branch, now = edited(1), edited(2)
    three = sides(spark, *[[(k, *v) for k, v in d.items()] for d in (base, branch, now)])
    want, conflicts = merged(base, branch, now)
    got = rebuild.rebuilt(*three, {T: ["k"]}, keep_conflicts=True)
    assert {r.k: (r.a, r.b) for r in got.table(*T).collect()} == want and conflicts > 3
    plan = rebuild.rebuild_plan(*three, {T: ["k"]}).first()
    assert (plan.action, plan.conflict) == ("resolve", conflicts)
    with pytest.raises(ValueError, match="app.orders conflict"):
        rebuild.rebuilt(*three, {T: ["k"]})


def test_edits_and_own_tables_without_conflicts(spark, rows):
    base, branch, now = sides(spark, [(1, "x", "x"), (2, "x", "x"), (3, "x", "x")], [(1, "mine", "x"), (2, "x", "x")],
                              [(1, "x", "now"), (2, "x", "now"), (3, "x", "x"), (4, "x", "x")])
    branch = branch.with_table("app", "coupons", spark.range(2).toDF("c"))
    plan = {r.table: (r.action, r.rows, r.take, r.merge, r.delete, r.conflict) for r in rebuild.rebuild_plan(base, branch, now, {T: ["k"]}).collect()}
    assert plan == {"orders": ("apply edits", 4, 0, 1, 1, 0), "coupons": ("load", 2, 0, 0, 0, 0)}
    side = rebuild.rebuilt(base, branch, now, {T: ["k"]})
    assert rows(side.table(*T)) == [(1, "mine", "now"), (2, "x", "now"), (4, "x", "x")] and side.table("app", "coupons").count() == 2
    assert side.name == "branch"


def test_every_action(spark):
    one = spark.range(1).toDF("k")
    named = lambda *names: Side("s", {("d", n): one for n in names})
    base, branch, now = named("same", "nokey", "left", "gone"), named("same", "nokey", "gone", "own", "both"), named("same", "nokey", "left", "both", "fresh")
    keys = {("d", n): ["k"] for n in ("same", "left", "gone", "own", "both", "fresh")}
    assert {r.table: r.action for r in rebuild.rebuild_plan(base, branch, now, keys).collect()} == {
        "same": "keep", "nokey": "no key", "left": "dropped on the branch", "gone": "dropped in production", "own": "load", "both": "resolve",
        "fresh": "new in production"}
    assert rebuild.rebuild_plan(Side("a"), Side("b"), Side("c"), {}).isEmpty()


def test_migrations_come_first(spark):
    base, branch, now = sides(spark, [(1, "x", "x")], [(1, "y", "x")], [(1, "x", "x")])
    evolved = now.with_table(*T, now.table(*T).withColumnRenamed("b", "c"))
    assert rebuild.rebuild_plan(base, branch, evolved, {T: ["k"]}).first().action == "columns differ"
    with pytest.raises(ValueError, match="migrations first"):
        rebuild.rebuilt(base, branch, evolved, {T: ["k"]})


def test_replication_readiness(spark):
    full = spark.createDataFrame([(1, 1), (1, 2), (None, 3)], "k int, v int")
    distinct = full.filter("v <> 2").dropna()
    source = {n: full for n in ("repeats", "nokey", "filled", "missing", "other")} | {"good": distinct, "nulls": full.filter("v <> 2"), "empty": full.limit(0)}
    target = {n: full.limit(0) for n in ("repeats", "nokey", "good", "nulls", "empty")} | {"filled": full, "other": full.limit(0).drop("v")}
    keys = {("d", n): ["k"] for n in source if n != "nokey"}
    got = {r.table: (r.rows, r.surplus, r.empty_keys, r.target_rows, r.problem) for r in rebuild.replication_readiness(
        Side.of("a", {"d": source}), Side.of("b", {"d": target}), keys).collect()}
    assert got == {"repeats": (3, 1, 1, 0, "key is empty"), "nokey": (3, None, None, 0, "no key"), "filled": (3, 1, 1, 3, "target is not empty"),
                   "missing": (3, 1, 1, None, "no target table"), "other": (3, 1, 1, 0, "columns differ"), "good": (1, 0, 0, 0, "none"),
                   "nulls": (2, 0, 1, 0, "key is empty"), "empty": (0, 0, 0, 0, "none")}
    assert rebuild.replication_readiness(Side("a"), Side("b"), {}).isEmpty()
