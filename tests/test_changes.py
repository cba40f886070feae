import pytest
from pyspark.sql import functions as F

from tableshift.operators import mutate, reconcile
from tableshift.operators.constraints import ForeignKey


def test_seed_of_the_app(spark):
    """The reference figures: 5,000 orders, amounts by the seed rule, loaded only into an empty table."""
    g = F.col("order_id")
    seed = spark.range(1, 5001).toDF("order_id").select(g, (1 + g % 1000).alias("customer_id"), (500 + g * 37 % 20000).alias("cents"))
    empty = spark.createDataFrame([], seed.schema)
    assert mutate.seed_if_empty(empty, seed).count() == 5000
    assert mutate.seed_if_empty(seed.limit(3), seed).count() == 3
    assert seed.agg(F.countDistinct("customer_id")).first()[0] == 1000
    updated = mutate.predicate_update(seed.withColumn("coupon", F.lit(None).cast("string")),
                                      (g % 97 == 0) & F.col("coupon").isNull(), {"coupon": F.lit("FALL10")})
    assert updated.filter("coupon = 'FALL10'").count() == 51


def test_insert_if_absent(spark, rows):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 9, 0), ("b", 3, 2), ("b", 2, 1)], "k string, v int, ord int")
    assert rows(mutate.insert_if_absent(target, batch, ["k"], ["ord"])) == [("a", 1), ("b", 2)]


def test_first_per_key_keeps_nulls(spark, rows):
    df = spark.createDataFrame([(1, None, 1), (1, "x", 2), (2, "y", 1)], "k int, v string, ord int")
    assert rows(mutate.first_per_key(df, ["k"], ["ord"])) == [(1, None, 1), (2, "y", 1)]
    assert rows(mutate.first_per_key(df.select("k"), ["k"], ["k"])) == [(1,), (2,)]


def test_keyed_update_sets_null_and_last_wins(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    updates = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, None, 1), (9, "z", 1)], "k int, v string, ord int")
    assert rows(mutate.keyed_update(df, updates, ["k"], ["ord"])) == [(1, "y"), (2, None), (3, "c")]


def test_unknown_condition_changes_nothing(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    assert rows(mutate.predicate_update(df, F.col("v") > 1, {"k": F.lit(0)})) == [(0, 5), (1, None)]


def test_ids_continue_after_the_move(spark, rows):
    """The five orders after the switch get 5026 to 5030; the old side stays at 5025."""
    orders = spark.range(1, 5026).toDF("order_id")
    batch = spark.createDataFrame([(f"c{i}",) for i in range(5)], "customer string").repartition(4)
    numbered = mutate.allocate_ids(batch, ["customer"], "order_id", orders.select(F.max("order_id")))
    assert rows(numbered) == [(5026 + i, f"c{i}") for i in range(5)]
    assert orders.agg(F.max("order_id")).first()[0] == 5025


def test_ids_do_not_depend_on_partitions(spark, rows):
    batch = spark.range(997).select((F.col("id") * 7919 % 997).alias("x"))
    first = rows(mutate.allocate_ids(batch.repartition(5), ["x"], "n", 10))
    assert first == rows(mutate.allocate_ids(batch.coalesce(1), ["x"], "n", 10))
    assert sorted(r[0] for r in first) == list(range(11, 1008)) and all(n == x + 11 for n, x in first)


def test_ids_of_an_empty_table_start_at_one(spark, rows):
    empty = spark.createDataFrame([], "order_id long")
    batch = spark.createDataFrame([("a",)], "x string")
    assert rows(mutate.allocate_ids(batch, ["x"], "order_id", empty.select(F.max("order_id")))) == [(1, "a")]


def test_smoke_write_changes_nothing(spark):
    orders = spark.range(1, 101).select(F.col("id").alias("order_id"), F.lit(100).alias("cents"))
    probe = spark.createDataFrame([(-1, 100)], "order_id long, cents int")
    assert tuple(mutate.smoke_write(orders, probe, ["order_id"]).first()) == (100, 101, 100, True)


def test_data_only_load_preconditions(spark, rows):
    flags = spark.createDataFrame([("a", True), ("b", False)], "flag string, enabled boolean")
    empty = spark.createDataFrame([], flags.schema)
    assert rows(mutate.data_only_load(empty, flags)) == [("a", True), ("b", False)]
    assert rows(mutate.data_only_load(empty, flags, leave_out=F.col("flag") == "a")) == [("b", False)]
    with pytest.raises(mutate.Rejected, match="already has rows"):
        mutate.data_only_load(flags, flags)
    with pytest.raises(mutate.Rejected, match="columns differ"):
        mutate.data_only_load(empty.withColumn("note", F.lit("")), flags)
    parent = spark.createDataFrame([("a",)], "flag string")
    with pytest.raises(mutate.Rejected, match="without a parent"):
        mutate.data_only_load(empty, flags, foreign_keys=[(ForeignKey(["flag"], "known", ["flag"]), parent)])


def test_a_colliding_load_is_rejected_whole(spark, rows):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    clash = spark.createDataFrame([(1, "b"), (2, "c"), (3, "d"), (3, "e")], "k int, v string")
    assert rows(mutate.collisions(target, clash, ["k"])) == [(1, "exists", 1), (3, "repeats", 2)]
    with pytest.raises(mutate.Rejected):
        mutate.checked_append(target, clash, ["k"])
    assert rows(mutate.checked_append(target, clash.filter("k = 2"), ["k"])) == [(1, "a"), (2, "c")]


def test_apply_changes(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    changes = spark.createDataFrame([(1, "x", 5, False), (1, None, 4, True), (2, None, 7, True), (2, "y", 6, False), (4, "z", 1, False)],
                                    "k int, v string, ver int, gone boolean")
    assert rows(mutate.apply_changes(target, changes, ["k"], "ver", F.col("gone"))) == [(1, "x"), (3, "c"), (4, "z")]


def test_branch_work_is_carried_over(spark, rows):
    """The reference figures: one branch-only coupon, three order edits (11, 22, 33), applied to newer production."""
    production = spark.range(1, 5001).select(F.col("id").alias("order_id"), F.when(F.col("id") % 97 == 0, "FALL10").alias("coupon"))
    coupons = spark.createDataFrame([("FALL10", 10)], "code string, percent_off int")
    branch_coupons = coupons.union(spark.createDataFrame([("DEV-TEST-50", 50)], coupons.schema))
    branch = mutate.predicate_update(production, F.col("order_id").isin(11, 22, 33), {"coupon": F.lit("DEV-TEST-50")})
    own = reconcile.branch_only(branch_coupons, coupons, ["code"])
    edits = reconcile.rows_using(branch, "coupon", own, "code")
    assert rows(own) == [("DEV-TEST-50", 50)] and rows(edits, "order_id") == [(11,), (22,), (33,)]
    newer = production.union(spark.range(5001, 5026).select("id", F.lit(None).cast("string")))
    new_coupons, new_orders = reconcile.carry_over(coupons, newer, own, edits, "code", "order_id")
    assert rows(new_coupons) == [("DEV-TEST-50", 50), ("FALL10", 10)]
    assert new_orders.filter("coupon = 'DEV-TEST-50'").count() == 3 and new_orders.count() == 5025


def test_three_way(spark, rows):
    def side(data):
        return spark.createDataFrame(data, "k int, a string, b string")
    base = side([(1, "a", "b"), (2, "a", "b"), (3, "a", "b"), (4, "a", "b"), (5, "a", "b"), (6, "a", None), (7, "a", "b"),
                 (8, "a", "b"), (9, "a", "b"), (13, "a", "b")])
    branch = side([(1, "a", "b"), (2, "X", "b"), (3, "a", "b"), (4, "X", "b"), (5, "X", "b"), (6, None, None), (8, "X", "b"),
                   (9, "a", "b"), (10, "n", "n"), (11, "n", "m")])
    target = side([(1, "a", "b"), (2, "a", "b"), (3, "Y", "b"), (4, "a", "Y"), (5, "Y", "b"), (6, "a", "Y"), (7, "Y", "b"),
                   (11, "n", "n"), (12, "t", "t"), (13, "a", "b")])
    merged = reconcile.three_way(base, branch, target, ["k"])
    assert rows(merged) == sorted([
        (1, "same", "", "a", "b"), (2, "take", "", "X", "b"), (3, "keep", "", "Y", "b"), (4, "merge", "", "X", "Y"),
        (5, "conflict", "a", "Y", "b"), (6, "merge", "", None, "Y"), (7, "conflict", "*deleted and edited*", "Y", "b"),
        (8, "conflict", "*edited and deleted*", None, None), (9, "gone", "", None, None), (10, "take", "", "n", "n"),
        (11, "conflict", "*inserted twice*", "n", "n"), (12, "keep", "", "t", "t"), (13, "delete", "", "a", "b")], key=repr)
    with pytest.raises(ValueError, match="conflicts"):
        reconcile.merged_table(merged, ["k"])
    with pytest.raises(Exception, match="key repeats"):
        reconcile.three_way(base.union(base), branch, target, ["k"]).collect()
    clean = reconcile.three_way(base.filter("k < 5"), branch.filter("k < 5"), target.filter("k < 5"), ["k"])
    assert rows(reconcile.merged_table(clean, ["k"])) == [(1, "a", "b"), (2, "X", "b"), (3, "Y", "b"), (4, "X", "Y")]
