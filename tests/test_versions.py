import pytest
from pyspark.sql import functions as F

from tableshift.functions.times import HOUR
from tableshift.operators.constraints import Rules
from tableshift.operators.digest import bag_fingerprint
from tableshift.operators.mutate import add_column
from tableshift.plans import migrate as mig
from tableshift.plans import move
from tableshift.sources import versions as vs
from tableshift.sources.schemas import create_own_schema, drop_own_schema

T0 = 1_700_000_040_000_000  # a whole minute


@pytest.fixture
def store(spark, tmp_path):
    return vs.VersionStore(spark, str(tmp_path / "store"))


def test_export_read_and_tags(spark, store, rows):
    assert store.latest_version() is None and store.tables() == {}
    assert store.export({"a": spark.range(3), "b": spark.range(2)}, T0, tag="first") == 1
    assert store.export({"a": spark.range(5)}, T0 + HOUR, keep_others=True) == 2
    assert store.read("a").count() == 5 and store.read("b").count() == 2 and store.read("a", 1).count() == 3
    assert rows(store.manifest().filter("tag = 'first'"), "table") == [("a",), ("b",)]
    assert rows(store.manifest(), "version", "table", "rows") == [(1, "a", 3), (1, "b", 2), (2, "a", 5), (2, "b", 2)]
    with pytest.raises(vs.NothingThere):
        store.read("c")
    with pytest.raises(vs.NotPublished, match="after"):
        store.export({"a": spark.range(1)}, T0)


def test_failed_validation_publishes_nothing(spark, store):
    store.export({"a": spark.range(3)}, T0)
    with pytest.raises(vs.NotPublished):
        store.export({"a": spark.range(9)}, T0 + 1, validate=lambda t: t["a"].filter("id = 8"))
    with pytest.raises(vs.NotPublished, match="expected"):
        store.export({"a": spark.range(9)}, T0 + 1, expect={"a": (8, "0")})
    assert store.latest_version() == 1 and store.read("a").count() == 3
    assert store.export({"a": spark.range(4)}, T0 + 2) == 2 and store.read("a").count() == 4


def test_failed_write_publishes_nothing(spark, store):
    store.export({"a": spark.range(3)}, T0)
    broken = spark.range(5).withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="boom"):
        store.export({"a": spark.range(9), "b": broken}, T0 + 1)
    assert store.latest_version() == 1 and store.read("a").count() == 3


def test_a_second_writer_is_refused(spark, store, monkeypatch):
    store.export({"a": spark.range(3)}, T0)
    late = vs.VersionStore(spark, store.root)
    stale = spark.createDataFrame(late.manifest().collect(), vs.MANIFEST_SCHEMA)
    store.export({"a": spark.range(4)}, T0 + 1)
    monkeypatch.setattr(late, "manifest", lambda: stale)
    before = store.manifest().filter("version = 2").first()
    with pytest.raises(vs.NotPublished, match="another writer"):
        late.export({"a": spark.range(99)}, T0 + 2)
    assert store.latest_version() == 2 and store.read("a").count() == 4 and store.manifest().filter("version = 2").first() == before
    assert bag_fingerprint(store.read("a")).first()["digest"] == before["digest"]


def test_a_crash_between_tables_shows_nothing(spark, store, monkeypatch):
    store.export({"a": spark.range(3), "b": spark.range(2)}, T0)
    monkeypatch.setattr(store, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        store.export({"a": spark.range(9), "b": spark.range(9)}, T0 + 1)
    again = vs.VersionStore(spark, store.root)
    assert again.latest_version() == 1 and again.read("a").count() == 3
    assert again.export({"a": spark.range(4)}, T0 + 1) == 2 and again.read("a").count() == 4


def test_small_changes_are_seen_by_the_read_back_proof(spark, store):
    store.export({"a": spark.sql("select 0.1D x union all select 1e15D")}, T0)
    mine = store.manifest().first()["digest"]
    for other in ("0.100000001D x union all select 1e15D", "0.1D x union all select 1000000000000001D"):
        assert bag_fingerprint(spark.sql(f"select {other}")).first()["digest"] != mine


def test_exclusions(spark, store, rows):
    store.export({"orders": spark.range(1), "audit_log": spark.range(1), "audit_view": spark.range(1)}, T0, exclude=["^audit_"])
    assert rows(store.manifest(), "table") == [("orders",)]
    names = spark.createDataFrame([("orders",), ("audit_log",)], "name string")
    assert rows(vs.unmatched_patterns(names, "name", ["^audit", "^legacy"])) == [("^legacy",)]
    edges = spark.createDataFrame([("view1", "audit_log"), ("view2", "view1"), ("x", "orders")], "name string, needed string")
    assert rows(move.excluded_names(names, "name", ["^audit"], edges)) == [
        ("audit_log", "pattern"), ("view1", "depends"), ("view2", "depends")]


def test_listing_filter(spark, rows):
    lines = [f"{i}; TABLE app t{i} app_owner" for i in range(48)] + [f"{i}; ACL x cloud_admin" for i in range(30)] + [
        "1; SCHEMA __db_system app_owner"] * 3
    listing = spark.createDataFrame([("app", x) for x in lines], "database string, line string")
    filtered = move.filter_listing(listing, "line", r" (cloud_admin|platform_admin)$|__db_system")
    assert rows(move.listing_counts(filtered)) == [("app", 81, 33)]
    assert filtered.filter("skipped").filter("line not like ';%'").isEmpty()


def test_restore(spark, store, tmp_path, rows):
    target = vs.VersionStore(spark, str(tmp_path / "target"))
    store.export({"a": spark.range(3), "b": spark.range(2)}, T0)
    assert move.restore(store, target, T0, exclude=["^b"]) == 1
    assert rows(target.manifest(), "table", "rows") == [("a", 3)]
    with pytest.raises(vs.NotPublished):
        move.restore(store, target, T0 + 1, rules={"b": Rules(checks={"small": "id < 1"})})
    assert target.latest_version() == 1
    with pytest.raises(vs.NotPublished, match="nothing"):
        move.restore(store, target, T0 + 1, exclude=["."])


def test_restore_notices_damage(spark, store, tmp_path):
    target = vs.VersionStore(spark, str(tmp_path / "target"))
    store.export({"a": spark.range(3)}, T0)
    spark.range(4).write.mode("overwrite").parquet(store.manifest().first()["path"])
    with pytest.raises(vs.NotPublished, match="expected"):
        move.restore(store, target, T0)
    assert target.latest_version() is None


def test_pending_restores(spark, rows):
    requested = spark.createDataFrame([("a",), ("b",), ("c",)], "database string")
    attempts = spark.createDataFrame([("b", 7), ("b", 5), ("a", 1)], "database string, started long")
    found = move.pending_restores(requested, requested.filter("database = 'a'"), attempts)
    assert rows(found) == [("b", 5, 2), ("c", None, 0)]


def test_retention(spark, rows):
    day = 86_400_000_000
    versions = spark.createDataFrame([(1, T0, False), (2, T0 + day, True), (3, T0 + 2 * day, False), (4, T0 + 3 * day, False)],
                                     "version int, committed_at long, no_expiry boolean")
    assert rows(vs.retention_plan(versions, T0 + 9 * day), "version", "expired", "readable") == [
        (1, True, False), (2, False, False), (3, True, True), (4, False, True)]
    with pytest.raises(ValueError):
        vs.retention_plan(versions, T0, history_days=31)


def steps(spark, fail_at=None):
    def coupons(tables):
        if fail_at == 3:
            raise RuntimeError("boom")
        return {"coupons": spark.createDataFrame([], "code string, percent_off int"),
                "orders": add_column(tables["orders"], "coupon_code", "string")}
    return [
        mig.Migration(1, "customers", lambda t: {"customers": spark.range(10)}),
        mig.Migration(2, "orders", lambda t: {"orders": spark.range(20)}),
        mig.Migration(3, "coupons", coupons),
        mig.Migration(4, "feature flags (unreleased)", lambda t: {"feature_flags": spark.createDataFrame([], "flag string")}),
    ]


def test_migrations_run_once_and_in_order(spark, store):
    """Production stops at version 3, development goes on to 4."""
    assert mig.migrate(store, list(reversed(steps(spark))), up_to=3, now=T0) == [1, 2, 3]
    assert store.read("orders").columns == ["id", "coupon_code"] and store.latest_version() == 3
    assert mig.migrate(store, steps(spark), up_to=3, now=T0 + HOUR) == [1, 2, 3] and store.latest_version() == 3
    assert mig.migrate(store, steps(spark), up_to=4, now=T0 + HOUR) == [1, 2, 3, 4]
    assert [r["version"] for r in store.read(mig.LEDGER).orderBy("version").collect()] == [1, 2, 3, 4]
    assert store.read("customers").count() == 10


def test_a_failed_migration_leaves_the_earlier_ones(spark, store):
    with pytest.raises(RuntimeError):
        mig.migrate(store, steps(spark, fail_at=3), up_to=4, now=T0)
    assert [r["version"] for r in store.read(mig.LEDGER).orderBy("version").collect()] == [1, 2]
    assert store.read("orders").columns == ["id"]


def test_baseline(spark, store):
    store.export({"customers": spark.range(1), "orders": spark.range(1)}, T0)
    assert mig.migrate(store, steps(spark), up_to=3, now=T0 + 1, baseline=2) == [3]


def test_ledger_history(spark, rows):
    ledger = spark.createDataFrame([("p", v) for v in (1, 2, 10)] + [("q", 1), ("q", 1)], "database string, version int")
    assert rows(mig.ledger_history(ledger, [1, 2, 10])) == [("p", "1,2,10", 10, True), ("q", "1", 1, False)]


def test_only_own_schemas_are_dropped(spark):
    assert create_own_schema(spark, "own_schema", "job-1") and not create_own_schema(spark, "own_schema", "job-1")
    assert not drop_own_schema(spark, "own_schema", "job-2") and spark.catalog.databaseExists("own_schema")
    assert drop_own_schema(spark, "own_schema", "job-1") and not spark.catalog.databaseExists("own_schema")
    assert not drop_own_schema(spark, "own_schema", "job-1")
