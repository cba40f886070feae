import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tableshift.operators import compare, diff
from tableshift.operators.constraints import ForeignKey, Rules, constraint_report
from tableshift.plans.verify import drill_down
from tableshift.sources.schema_text import read_schema_files, schema_lines
from tableshift.sources.sides import Side


def test_row_diff_is_null_safe(spark, rows):
    schema = "k int, a string, b double"
    old = spark.createDataFrame([(1, "x", 1.0), (2, None, 1.0), (3, "x", None), (4, "x", 1.0), (6, None, None)], schema)
    new = spark.createDataFrame([(1, "x", 1.0), (2, "y", None), (3, "x", None), (5, "x", 1.0), (6, None, None)], schema)
    assert rows(diff.row_diff(old, new, ["k"])) == [(2, "changed", "a,b"), (4, "removed", ""), (5, "added", "")]
    assert ("changed", 1, 3) not in rows(diff.row_diff(old, new, ["k"], include_same=True), "change")
    assert rows(diff.changed_column_counts(diff.row_diff(old, new, ["k"]))) == [("a", 1), ("b", 1)]


def test_row_diff_refuses_a_repeated_key(spark):
    old = spark.createDataFrame([(1, "x"), (1, "y")], "k int, a string")
    with pytest.raises(PySparkException, match="key repeats"):
        diff.row_diff(old, old.limit(1), ["k"]).collect()
    missing = spark.createDataFrame([(None, "x")], old.schema)
    with pytest.raises(PySparkException, match="key repeats"):
        diff.row_diff(missing, missing, ["k"]).collect()
    with pytest.raises(diff.NotAKey):
        diff.require_key(old, ["k"])


def test_row_diff_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        side = spark.range(100).withColumn("a", F.col("id") * 2)
        plan = diff.row_diff(side, side.filter("id > 3"), ["id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_pruned_row_diff_agrees(spark, rows):
    old = spark.range(5000).withColumn("v", F.col("id") % 7)
    new = old.filter("id <> 17").withColumn("v", F.when(F.col("id") == 99, -1).otherwise(F.col("v")))
    assert rows(diff.pruned_row_diff(old, new, ["id"])) == rows(diff.row_diff(old, new, ["id"])) == [
        (17, "removed", ""), (99, "changed", "v")]
    assert diff.pruned_row_diff(old, old, ["id"]) is None


def test_drill_down_skips_identical_tables(spark, rows):
    a = spark.range(50).withColumn("v", F.lit(1))
    old, new = Side.of("o", {"db": {"t": a, "u": a}}), Side.of("n", {"db": {"t": a, "u": a.filter("id <> 5")}})
    found = drill_down(old, new, {("db", "t"): ["id"], ("db", "u"): ["id"]})
    assert list(found) == [("db", "u")] and rows(found[("db", "u")], "id", "change") == [(5, "removed")]


def test_one_changed_cell_is_seen_everywhere(spark):
    """Mutations: one cell, one row, one duplicate. Each must be noticed by digest, buckets and bag diff."""
    base = spark.range(200).select("id", (F.col("id") % 3).alias("a"), F.sqrt("id").alias("x"))
    mutants = [base.withColumn("a", F.when(F.col("id") == 7, F.lit(None)).otherwise(F.col("a"))),
               base.withColumn("x", F.when(F.col("id") == 7, F.col("x") + 0.001).otherwise(F.col("x"))),
               base.filter("id <> 7"), base.union(base.filter("id = 7"))]
    for mutant in mutants:
        assert not compare.copy_compare(Side.of("o", {"d": {"t": base}}), Side.of("n", {"d": {"t": mutant}})).first()["identical"]
        assert compare.bucket_compare(base, mutant, ["id"]).filter("not identical").count() == 1
        assert diff.bag_diff(base, mutant).count() in (1, 2)


def test_bag_diff_counts_copies(spark, rows):
    old = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "x string, y int")
    new = spark.createDataFrame([("a", None), ("b", 1), ("b", 1), ("c", 2)], "x string, y int")
    assert rows(diff.bag_diff(old, new)) == [("a", None, -1), ("b", 1, 1), ("c", 2, 1)]


def test_change_rows(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    found = diff.change_rows(diff.row_diff(old, new, ["k"], keep_values=True), ["k"], ["v"], 9)
    assert rows(found) == [("delete", 9, 1, "a"), ("insert", 9, 3, "d"), ("update_post", 9, 2, "c"), ("update_pre", 9, 2, "b")]


def test_watermark_of_the_app(spark, rows):
    """5,000 orders, 25 more before the pause: the newest id and the count are both 5,025, and then stand still."""
    orders = spark.range(1, 5001).union(spark.range(5001, 5026)).toDF("order_id")
    assert tuple(compare.watermark(orders, "order_id").first()) == (5025, 5025)
    again = compare.watermark_compare({"orders": (orders, "order_id")}, {"orders": (orders, "order_id")})
    assert again.first()["matches"]
    assert not compare.watermark_compare({"o": (orders, "order_id")}, {"o": (orders.filter("order_id <> 3"), "order_id")}).first()["matches"]


def test_sequences(spark, rows):
    old = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10)], "sequence string, last_value long")
    new = spark.createDataFrame([("a", 10, 10), ("b", 12, 14), ("d", None, None)], "sequence string, last_value long, newest_id long")
    assert rows(compare.sequence_compare(old, new), "sequence", "ok", "covers_ids", "reset_to") == [
        ("a", True, True, 11), ("b", False, False, 15), ("c", False, True, 1), ("d", True, True, 1)]
    assert rows(compare.sequence_compare(old, new, "at_or_past"), "sequence", "ok") == [
        ("a", True), ("b", True), ("c", False), ("d", True)]


def test_schema_diff(spark, rows):
    old = {"t": spark.createDataFrame([(1, "a", 2.0)], "a int, b string, c double")}
    new = {"t": spark.createDataFrame([(1, None, 2)], "b int, a string, d long").select("a", "b", "d")}
    found = compare.schema_diff(compare.schema_rows(old), compare.schema_rows(new))
    assert rows(found, "column", "status") == [("a", "retyped"), ("b", "retyped"), ("c", "missing"), ("d", "added")]
    declared = compare.declared_schema_rows(spark, {"t": old["t"].schema})
    assert compare.schema_diff(declared, declared).filter("status <> 'same'").isEmpty()


def test_schema_texts(spark, rows, tmp_path):
    (tmp_path / "old").mkdir(), (tmp_path / "new").mkdir()
    (tmp_path / "old" / "app.sql").write_text("-- dump 1\nSET x = 1;\n\nCREATE TABLE a;\r\nCREATE TABLE b;\n")
    (tmp_path / "new" / "app.sql").write_text("-- dump 2\n\\restrict k\nCREATE TABLE a;\nCREATE TABLE c;\nEND;\n")
    old, new = [schema_lines(read_schema_files(spark, str(tmp_path / s))) for s in ("old", "new")]
    assert rows(compare.text_diff(old, new)) == [("app.sql", 2, 3, 2, 1, False)]
    assert rows(compare.text_diff(old, old)) == [("app.sql", 2, 2, 0, None, True)]


def test_all_true(spark):
    def of(data, strict=True):
        return spark.createDataFrame(data, "x boolean").agg(compare.all_true(F.col("x"), strict).alias("r")).first()["r"]
    assert of([(True,), (True,)]) and not of([(True,), (False,)]) and not of([(True,), (None,)])
    assert not of([]) and of([], strict=False)


def test_ledger_compare(spark, rows):
    actual = spark.createDataFrame([("p", 1), ("p", 2), ("p", 9)], "database string, version int")
    expected = spark.createDataFrame([("p", 1), ("p", 2), ("p", 3)], "database string, version int")
    assert rows(compare.ledger_compare(actual, expected), "version", "state") == [
        (1, "applied"), (2, "applied"), (3, "missing"), (9, "unexpected")]


def test_constraints(spark, rows):
    parents = spark.createDataFrame([("A",), ("B",)], "code string")
    orders = spark.createDataFrame([(1, "A", 10), (1, "Z", 91), (2, None, None), (None, "Z", 90), (None, "A", 0)],
                                   "id int, code string, pct int")
    found = constraint_report({"orders": orders, "coupons": parents}, {"orders": Rules(
        primary_key=["id"], unique=[["code"]], checks={"pct": "pct between 1 and 90"},
        foreign_keys=[ForeignKey(["code"], "coupons", ["code"])])})
    assert rows(found, "kind", "rule", "violations") == [
        ("check", "pct", 2), ("foreign_key", "code->coupons", 2), ("not_null", "id", 2), ("primary_key", "id", 1),
        ("unique", "code", 2)]


def test_small_and_large_changes_are_seen(spark):
    for before, after in ((0.1, 0.1 + 1e-9), (1e15, 1e15 + 1), (1.0, 1.0 + 2**-52)):
        a, b = [spark.createDataFrame([(1, x)], "k int, v double") for x in (before, after)]
        old, new = Side.of("o", {"d": {"t": a}}), Side.of("n", {"d": {"t": b}})
        assert not compare.copy_compare(old, new).first()["identical"]
        assert compare.bucket_compare(a, b, ["k"]).filter("not identical").count() == 1
        assert drill_down(old, new, {("d", "t"): ["k"]})[("d", "t")].first()["changed_columns"] == "v"


def test_one_sided_columns_and_tables_are_not_lost(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    wider = a.withColumn("extra", F.when(F.col("k") == 1, "e"))
    for left, right in ((a, wider), (wider, a), (a, a.withColumn("v", F.lit(1)))):
        with pytest.raises(diff.DifferentColumns):
            diff.row_diff(left, right, ["k"])
        with pytest.raises(diff.DifferentColumns):
            diff.bag_diff(left, right)
    assert diff.row_diff(a, wider, ["k"], ["v"]).isEmpty()
    keys = {("d", "t"): ["k"], ("d", "gone"): ["k"], ("d", "fresh"): ["k"], ("d", "typed"): ["k"]}
    old = Side.of("o", {"d": {"t": a, "gone": a, "typed": spark.createDataFrame([(1, 5)], "k int, v int")}})
    new = Side.of("n", {"d": {"t": wider, "fresh": a, "typed": spark.createDataFrame([(1, "5")], "k int, v string")}})
    found = drill_down(old, new, keys)
    assert set(found) == {("d", "t"), ("d", "gone"), ("d", "fresh")}
    assert rows(found[("d", "t")]) == [(1, "changed", "extra")]
    assert rows(found[("d", "gone")], "k", "change") == [(1, "removed"), (2, "removed")]
    assert rows(found[("d", "fresh")], "k", "change") == [(1, "added"), (2, "added")]


def test_an_empty_side(spark, rows):
    side, empty = Side.of("o", {"d": {"t": spark.range(3)}}), Side.of("n", {})
    assert rows(compare.copy_compare(side, empty)) == [("d", "t", 3, None, False)]
    assert compare.copy_compare(empty, empty).isEmpty() and constraint_report({}, {}).isEmpty()


def test_columns_named_like_helpers(spark, rows):
    schema = "k int, delta int, here int, old_here string, copies int"
    a, b = [spark.createDataFrame([(1, x, 1, "y", 1)], schema) for x in (1, 2)]
    assert rows(diff.row_diff(a, b, ["k"])) == [(1, "changed", "delta")]
    assert rows(diff.pruned_row_diff(a, b, ["k"], keep_values=True), "old_delta", "new_delta") == [(1, 2)]
    assert diff.bag_diff(a, b).columns[-1] == "delta_" and rows(diff.bag_diff(a, b), "delta", "delta_") == [(1, -1), (2, 1)]
