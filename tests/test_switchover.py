"""What became of writes around a switch, the rescue of stranded rows, and the rebuild of access rules."""

import random

from pyspark.sql import functions as F

from tableshift.operators import switchover as sw

SENT = "k int, at long"


def frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k int")


def test_every_outcome(spark, rows):
    sent = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (4, 12), (5, 25), (6, 25), (7, 25), (8, 25), (9, None), (10, 10), (11, 20), (12, 12),
                                  (None, 5)], SENT)
    old, new = frame(spark, [1, 2, 6, 9, None]), frame(spark, [1, 4, 5, 7, 7, 10, 11, 90, 90, None])
    got = {r.k: r.outcome for r in sw.write_continuity(sent, old, new, ["k"], "at", 10, 20).collect()}
    assert got == {1: "carried", 2: "left behind", 3: "lost", 4: "within the pause", 5: "served", 6: "stranded", 7: "repeated", 8: "lost",
                   9: "undated", 10: "carried", 11: "served", 12: "lost", 90: "unsent", None: "carried"}
    empty = sent.limit(0)
    assert sw.write_continuity(empty, old.limit(0), new.limit(0), ["k"], "at", 10, 20).isEmpty()
    summary = sw.continuity_summary(sw.write_continuity(sent, old, new, ["k"], "at", 10, 20))
    assert (("carried", 3, 5, 10, True)) in rows(summary) and ("unsent", 1, None, None, False) in rows(summary)


def test_a_live_writer_loses_nothing(spark):
    """One order a second through a pause: 0 of 5,000 lost, as in a clean switch; then one is."""
    sent = spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("at")).filter("at <= 2000 or at >= 2300")
    old, new = sent.filter("at <= 2000").select("k"), sent.select("k")
    outcomes = sw.write_continuity(sent, old, new, ["k"], "at", 2000, 2300)
    assert sw.continuity_summary(outcomes).filter("not kept").isEmpty()
    outcomes = sw.write_continuity(sent, old, new.filter("k <> 3000"), ["k"], "at", 2000, 2300)
    assert [tuple(r) for r in outcomes.filter("outcome = 'lost'").select("k", "on_old", "on_new").collect()] == [(3000, 0, 0)]


def test_a_repeated_acknowledgement_is_one_write_each(spark):
    sent = spark.createDataFrame([(1, 5), (1, 6)], SENT)
    got = sw.write_continuity(sent, frame(spark, [1, 1]), frame(spark, [1, 1]), ["k"], "at", 10, 20).first()
    assert (got.sent_at, got.on_old, got.on_new, got.outcome) == (6, 2, 2, "carried")


def test_stranded_rows_get_fresh_ids_and_keep_their_children(spark, rows):
    """New ids 5026 to 5030 went to the new side; three orders of the old side took the same numbers."""
    new = spark.createDataFrame([(i, "new") for i in range(5020, 5031)], "order_id long, side string")
    late = spark.createDataFrame([(i, "late") for i in (5026, 5027, 5040)], "order_id long, side string")
    items = spark.createDataFrame([(1, 5026), (2, 5026), (3, 5040), (4, 17)], "item long, order_id long")
    appended, children, ids = sw.rescue(late, new, "order_id", {"items": (items, "order_id")})
    assert rows(ids) == [(5026, 5031, True), (5027, 5032, True), (5040, 5033, False)]
    assert rows(appended) == [(5031, "late"), (5032, "late"), (5033, "late")] and appended.columns == late.columns
    assert rows(children["items"]) == [(1, 5031), (2, 5031), (3, 5033)]
    assert sw.rescue_ids(late.limit(0), new, "order_id").isEmpty()
    assert rows(sw.rescue_ids(late, new.limit(0), "order_id"), "new_id") == [(1,), (2,), (3,)]


def side(spark, roles=(), members=(), owners=(), grants=(), defaults=()):
    return {"roles": spark.createDataFrame([(r,) for r in roles], "role string"),
            "members": spark.createDataFrame(list(members), "role string, member string"),
            "owners": spark.createDataFrame(list(owners), "database string, schema string, table string, owner string"),
            "grants": spark.createDataFrame(list(grants), "database string, schema string, table string, grantee string, privilege string"),
            "defaults": spark.createDataFrame(list(defaults), "database string, schema string, owner string, grantee string, privilege string")}


def test_access_rebuild(spark, rows):
    t = ("db", "app", "orders")
    old = side(spark, ["own", 'odd"name', "cloud_admin", None], [("own", "ci"), ("cloud_admin", "ci")],
               [(*t, "own"), ("db", "app", "gone", "own"), ("db", "app", "kept", "own")],
               [(*t, "reader", "SELECT"), (*t, "reader", "SELECT"), (*t, "PUBLIC", "SELECT"), (*t, "cloud_admin", "SELECT"), ("db", "app", "gone", "reader", "SELECT")],
               [("db", "app", "own", "reader", "SELECT")])
    new = side(spark, ["me"], [], [(*t, "me"), ("db", "app", "kept", "own")], [])
    assert rows(sw.access_rebuild(old, new, ["^cloud_"])) == sorted([
        (1, None, 'CREATE ROLE "odd""name"'), (1, None, 'CREATE ROLE "own"'), (2, None, 'GRANT "own" TO "ci"'),
        (3, "db", 'GRANT CREATE ON SCHEMA "app" TO "own"'), (4, "db", 'ALTER TABLE "app"."orders" OWNER TO "own"'),
        (5, "db", 'REVOKE CREATE ON SCHEMA "app" FROM "own"'), (6, "db", 'GRANT SELECT ON "app"."orders" TO "reader"'),
        (6, "db", 'GRANT SELECT ON "app"."orders" TO PUBLIC'),
        (7, "db", 'ALTER DEFAULT PRIVILEGES FOR ROLE "own" IN SCHEMA "app" GRANT SELECT ON TABLES TO "reader"')], key=repr)
    assert sw.access_rebuild(old, old).isEmpty()
    assert {r.statement for r in sw.access_rebuild(old, new).filter("step = 1").collect()} == {
        'CREATE ROLE "odd""name"', 'CREATE ROLE "own"', 'CREATE ROLE "cloud_admin"'}


def test_continuity_of_random_writes_against_a_count(spark):
    rng = random.Random(4)
    sent = [(rng.randrange(60), rng.randrange(30)) for _ in range(50)]
    old, new = [rng.randrange(60) for _ in range(40)], [rng.randrange(60) for _ in range(40)]
    got = {r.k: (r.sent_at, r.on_old, r.on_new) for r in sw.write_continuity(
        spark.createDataFrame(sent, SENT), frame(spark, old), frame(spark, new), ["k"], "at", 10, 20).collect()}
    keys = {k for k, _ in sent} | {*old, *new}
    assert got == {k: (max((a for x, a in sent if x == k), default=None), old.count(k), new.count(k)) for k in keys}
