import hashlib

import pytest
from pyspark.sql import functions as F

from tableshift.functions.canon import EMPTY_DIGEST
from tableshift.operators import compare, digest
from tableshift.sources.sides import Side


def prints(df, **options):
    return tuple(digest.bag_fingerprint(df, **options).first())


def tree(df):
    return tuple(digest.tree_digest(df).first())


def frame(spark, data, schema="a string, b string"):
    return spark.createDataFrame(data, schema)


PAIRS = [
    ([("a", None)], [("a", "")]),
    ([("a", None)], [(None, "a")]),
    ([("a|b", "c")], [("a", "b|c")]),
    ([("a\\", "|b")], [("a", "\\|b")]),
    ([("\\N", "x")], [(None, "x")]),
    ([("a", "b")], [("b", "a")]),
    ([("a", "b")], [("a", "b"), ("a", "b")]),
    ([("a", "b"), ("a", "b")], [("c", "d"), ("c", "d")]),
    ([("a", "b")], []),
]


@pytest.mark.parametrize("left, right", PAIRS)
def test_different_rows_differ(spark, left, right):
    assert prints(frame(spark, left)) != prints(frame(spark, right))
    assert tree(frame(spark, left)) != tree(frame(spark, right))


def test_order_and_partitioning_do_not_count(spark):
    df = spark.range(1000).withColumn("x", F.sqrt("id"))
    other = df.orderBy(F.desc("id")).repartition(7)
    assert prints(df) == prints(other)
    assert tree(df) == tree(other)


def test_empty(spark):
    empty = frame(spark, [])
    assert prints(empty) == (0, "0:0")
    assert tree(empty) == (0, EMPTY_DIGEST)


def test_digest_is_the_sum_of_md5_parts(spark):
    hashes = [hashlib.md5(t).hexdigest() for t in (b"a|1", b"b|\\N", b"b|\\N")]
    expected = ":".join(str(sum(int(h[a:a + 15], 16) for h in hashes)) for a in (0, 15))
    df = frame(spark, [("a", 1), ("b", None), ("b", None)], "a string, b int")
    assert prints(df) == (3, expected)


def test_tree_digest_shape(spark):
    df = frame(spark, [("a",), ("b",), ("b",)], "a string")
    hashes = sorted((hashlib.md5(t).hexdigest(), n) for t, n in ((b"a", 1), (b"b", 2)))
    level = sorted((h[:6], hashlib.md5(f"{h}:{n}".encode()).hexdigest()) for h, n in hashes)
    for depth in (4, 2, 0):
        above = {}
        for p, d in level:
            above.setdefault(p[:depth], []).append(f"{p}:{d}")
        level = sorted((p, hashlib.md5("|".join(c).encode()).hexdigest()) for p, c in above.items())
    assert tree(df) == (3, level[0][1])


def test_tree_digest_does_not_depend_on_the_count(spark):
    """Beyond a million rows, the digest is that of the same rows in any other order and partitioning."""
    rows = spark.range(1_100_000)
    assert tree(rows) == tree(rows.orderBy(F.col("id").desc()).repartition(3))
    with pytest.raises(ValueError):
        digest.tree_digest(rows, depth=3)


def test_hot_row_is_one_leaf_entry(spark):
    """A third of all rows being equal changes the count, not the size of a group."""
    df = spark.range(3000).withColumn("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    assert tree(df)[0] == 3000


def test_doubles(spark):
    def one(x, **options):
        return prints(spark.createDataFrame([(x,)], "x double"), **options)
    assert one(0.1) != one(0.1 + 1e-9) and one(1e15) != one(1e15 + 1) and one(0.0) == one(-0.0)
    assert one(0.1, exact=False) == one(0.1 + 1e-9, exact=False) != one(0.100001, exact=False)
    assert one(0.1, exact=False, scale={"x": 9}) != one(0.1 + 1e-9, exact=False, scale={"x": 9})
    assert len({one(x) for x in (float("nan"), float("inf"), float("-inf"), 1e300, 1e301, 0.0, None)}) == 7


def test_nested_columns(spark):
    def one(value, kind):
        return prints(spark.createDataFrame([(value,)], f"x {kind}"))
    assert one(["a,b"], "array<string>") != one(["a", "b"], "array<string>")
    assert one([None], "array<string>") != one([], "array<string>") != one(None, "array<string>")
    assert one([["a]", "[b"]], "array<array<string>>") != one([["a"], ["b"]], "array<array<string>>")
    assert one(("a", None), "struct<p: string, q: string>") != one((None, "a"), "struct<p: string, q: string>")
    assert one({"a": 1, "b": 2}, "map<string, int>") == one({"b": 2, "a": 1}, "map<string, int>")
    assert one(bytearray(b"\x00"), "binary") != one(bytearray(b""), "binary")


def test_copy_compare_one_sided_and_changed(spark, rows):
    a, b = spark.range(10).toDF("id"), spark.range(10).toDF("id")
    old = Side.of("old", {"db": {"same": a, "changed": a, "old_only": a}})
    new = Side.of("new", {"db": {"same": b, "changed": b.withColumn("id", F.when(F.col("id") == 3, 4).otherwise(F.col("id"))),
                                 "new_only": b}})
    assert rows(compare.copy_compare(old, new)) == [
        ("db", "changed", 10, 10, False), ("db", "new_only", None, 10, False),
        ("db", "old_only", 10, None, False), ("db", "same", 10, 10, True)]


def test_fingerprints_in_batches(spark, rows, monkeypatch):
    side = Side.of("s", {"db": {f"t{i}": spark.range(i) for i in range(5)}})
    monkeypatch.setattr(digest, "TABLES_PER_PLAN", 2)
    assert rows(digest.fingerprint(side), "table", "rows") == [(f"t{i}", i) for i in range(5)]


def test_fingerprint_sends_one_row_per_task(spark):
    df = spark.range(0, 1000, 1, 4).withColumn("x", F.col("id") * 2)
    plan = digest.bag_fingerprint(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan and "Sort" not in plan
