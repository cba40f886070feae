import pytest
from pyspark.sql import functions as F

from tableshift.functions import text as tx
from tableshift.functions.times import off_whole_minute
from tableshift.operators import audit
from tableshift.sources import sides


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x")).alias("r")).first()["r"]


@pytest.mark.parametrize("address, expected", [
    ("Ana.Maria@example.com", "ana-maria"), ("__x__@example.com", "x"), ("@example.com", "user"), ("---@x", "user"),
    ("a-very-long-name-indeed@x", "a-very-long-name"), ("fifteen-chars-x-y@x", "fifteen-chars-x"), ("no at sign", "no-at-sign")])
def test_slug(spark, address, expected):
    assert one(spark, address, tx.slug) == expected


@pytest.mark.parametrize("url, problem, clean", [
    ("https://one.cloud.example.com", "ok", "https://one.cloud.example.com"),
    ("https://One.Cloud.example.com/browse?o=1#x", "ok", "https://one.cloud.example.com"),
    ("one.cloud.example.com/path", "ok", "https://one.cloud.example.com"),
    ("HTTPS://one.cloud.example.com", "ok", "https://one.cloud.example.com"),
    ("https://one.cloud.example.com:", "ok", "https://one.cloud.example.com"),
    ("http://one.cloud.example.com", "scheme", None),
    ("https://me@one.cloud.example.com", "user", None),
    ("https://:pw@one.cloud.example.com", "password", None),
    ("https://one.cloud.example.com:8443", "port", None),
    ("https://accounts.cloud.example.com", "blocked host", None),
    ("https://one.example.org", "foreign host", None),
    ("https://evil.test/one.cloud.example.com", "foreign host", None),
    ("", "foreign host", None)])
def test_url(spark, url, problem, clean):
    df = spark.createDataFrame([(url,)], "url string")
    assert tuple(audit.url_audit(df, "url", [".cloud.example.com"]).first())[1:] == (problem, clean)


@pytest.mark.parametrize("text, kind", [
    ("Error: INTERNAL_ERROR, try again", "temporary"), ("the call timed out", "temporary"), ("Please try again later.", "temporary"),
    ("TEMPORARILY_UNAVAILABLE", "temporary"), ("[PERMISSION_DENIED] no", "permission"), ("[NO_SUCH_CATALOG] x", "missing"),
    ("CATALOG_NOT_FOUND", "missing"), ("internal_error", "other")])
def test_error_class(spark, text, kind):
    assert one(spark, text, tx.error_class) == kind


def test_error_brief(spark):
    text = "(org.example.Some$Error)  first\n  second\tthird JVM stacktrace: at x"
    assert one(spark, text, tx.error_brief) == "first second third"
    assert one(spark, "w " * 500, tx.error_brief) == ("w " * 500)[:200]


def test_stale_names(spark):
    now = 1_700_000_000
    def stale(name):
        return one(spark, name, lambda c: tx.is_stale(c, now))
    assert stale(f"pre-{(now - 1801) * 1000}") and not stale(f"pre-{(now - 1800) * 1000}")
    assert not stale(f"pre-{(now - 9999) * 1000}-x") and not stale("pre-123") and not stale(None)


def test_whole_minute(spark):
    assert [one(spark, s, off_whole_minute, "long") for s in (1791909960, 1791909967, 1791909970, 1791909901)] == [
        1791909959, 1791909967, 1791909970, 1791909901]


def test_resource_path(spark):
    df = spark.createDataFrame([("x", "y"), ("x", None)], "p string, b string")
    assert [r[0] for r in df.select(tx.resource_path(projects=F.col("p"), branches=F.col("b"))).collect()] == [
        "projects/x/branches/y", "projects/x"]


def test_access(spark, rows):
    tables = spark.createDataFrame([("d", "old", "owner", 1), ("d", "later", "owner", 9), ("d", "other", "someone", 9),
                                    ("d", "direct", "someone", 1)], "database string, table string, owner string, created int")
    direct = spark.createDataFrame([("d", "direct", "reader"), ("d", "old", "writer")], "database string, table string, grantee string")
    default = spark.createDataFrame([("d", "owner", 5, "reader"), ("d", "owner", 7, "reader"), ("d", "someone", 1, "writer")],
                                    "database string, owner string, since int, grantee string")
    assert rows(audit.access_report(tables, direct, default, "reader"), "table", "can_read") == [
        ("direct", True), ("later", True), ("old", False), ("other", False)]


def test_leftovers(spark, rows):
    expected = spark.createDataFrame([("a", "lab"), ("b", "lab"), ("c", "lab"), ("d", "lab")], "name string, label string")
    found = spark.createDataFrame([("a", "lab"), ("b", "theirs"), ("d", None), ("z", "lab")], "name string, label string")
    assert rows(audit.leftovers(expected, found)) == [
        ("a", "ours", "delete"), ("b", "not ours", "leave"), ("c", "absent", "none"), ("d", "not ours", "leave")]


def test_compatibility(spark, rows):
    used = spark.createDataFrame([("pg", "17.2"), ("pg", "17.11"), ("ext", "1.0"), ("gis", "3")], "feature string, version string")
    offered = spark.createDataFrame([("pg", "17.9"), ("ext", "1.0.1")], "feature string, version string")
    assert rows(audit.compatibility(used, offered)) == [
        ("ext", "1.0", "1.0.1", "ok"), ("gis", "3", None, "missing"), ("pg", "17.11", "17.9", "too old")]


def test_missing_names_with_null(spark, rows):
    a = spark.createDataFrame([("x",), ("y",), ("x",)], "n string")
    b = spark.createDataFrame([("y",), (None,)], "n string")
    assert rows(audit.missing_names(a, b, ["n"])) == [("x",)]


def test_open_sessions(spark, rows):
    df = spark.createDataFrame([("app", "active"), ("app", "idle"), ("app", "idle in transaction (aborted)"), ("app", None),
                                ("reporting", "idle"), ("else", "active")], "database string, state string")
    assert rows(audit.open_sessions(df, ["app", "reporting"])) == [("app", 2), ("reporting", 0)]


def test_catalog_sides(spark, rows):
    spark.sql("create schema if not exists shop")
    try:
        spark.range(3).write.mode("overwrite").saveAsTable("shop.orders")
        spark.sql("create or replace view shop.recent as select * from shop.orders")
        side = sides.Side.from_catalog(spark, "old", ["shop"])
        assert list(side.tables) == [("shop", "orders")] and side.databases() == ["shop"]
        assert spark.catalog.tableExists("shop.orders") and not spark.catalog.tableExists("shop.none")
    finally:
        spark.sql("drop schema shop cascade")


def test_branch_view_isolation(spark, rows):
    """A branch shows the parent's rows as of its creation plus its own; neither side sees the other's later writes."""
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    overlay = spark.createDataFrame([(2, "B", False), (3, None, True), (4, "d", False)], "k int, v string, deleted boolean")
    assert rows(sides.branch_view(parent, overlay, ["k"])) == [(1, "a"), (2, "B"), (4, "d")]
    assert rows(parent) == [(1, "a"), (2, "b"), (3, "c")]


def test_scan_binds_values(spark):
    df = spark.createDataFrame([("a'; --",), ("b",)], "x string")
    assert sides.scan(spark, "select * from {t} where x = :v", {"v": "a'; --"}, t=df).count() == 1
