import random

import pytest
from pyspark.sql import functions as F

from tableshift.functions.times import SECOND
from tableshift.operators import slots, sync
from tableshift.sources.versions import VersionStore
from tableshift.streaming import jobs


def log(seed=1, n=400):
    """Random writes; one key holds a third of them, and moments repeat."""
    r = random.Random(seed)
    return [("hot" if i % 3 == 0 else r.choice("abc"), r.randrange(0, 5000), i) for i in range(n)]


@pytest.mark.parametrize("slot", [1, 37, 1000, 10**9])
def test_gaps_do_not_depend_on_the_slot(spark, rows, slot):
    data = log()
    expected, last = [], {}
    for key, at, i in sorted(data, key=lambda x: (x[0], x[1], x[2])):
        expected.append((key, at, i, at - last[key] if key in last else None))
        last[key] = at
    df = spark.createDataFrame(data, "k string, at long, i long")
    assert rows(slots.write_gaps(df, ["k"], "at", ["i"], slot_micros=slot), "k", "at", "i", "gap_micros") == sorted(expected, key=repr)


@pytest.mark.parametrize("slot", [1, 53, 10**9])
def test_as_of_against_brute_force(spark, rows, slot):
    moments, commits = log(2), log(3, 60)
    df = spark.createDataFrame(moments, "k string, at long, i long")
    versions = spark.createDataFrame(commits, "k string, at long, version long")
    expected = []
    for k, at, i in moments:
        known = [(a, v) for key, a, v in commits if key == k and a <= at]
        expected.append((k, at, i, max(known)[1] if known else None))
    assert rows(slots.as_of_version(df, versions, ["k"], "at", "version", slot_micros=slot)) == sorted(expected, key=repr)


def test_a_hot_key_is_spread_over_slots(spark):
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    df = spark.range(1000).select(key, (F.col("id") * 10).alias("at"))
    plan = slots.write_gaps(df, ["k"], "at", slot_micros=100)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key0" in plan and "_slot" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_slot_width_follows_the_densest_key(spark):
    df = spark.createDataFrame(log(), "k string, at long, i long").withColumn("at", F.col("at") * SECOND)
    assert slots.choose_slot(df, ["k"], "at", most_rows=1000) == 86_400 * SECOND
    assert slots.choose_slot(df, ["k"], "at", most_rows=120) == 3600 * SECOND
    assert slots.choose_slot(df, ["k"], "at", most_rows=0) == SECOND
    assert slots.choose_slot(df.limit(0), ["k"], "at") == 86_400 * SECOND


def test_rows_without_key_or_moment_are_kept(spark, rows):
    df = spark.createDataFrame([(None, 5), (None, 9), ("a", None), ("a", 7), (None, None)], "k string, at long")
    assert rows(slots.write_gaps(df, ["k"], "at", slot_micros=3)) == sorted(
        [(None, 5, None), (None, 9, 4), ("a", None, None), ("a", 7, None), (None, None, None)], key=repr)


def test_pause_length(spark, rows):
    df = spark.createDataFrame([("a", 5), ("a", 10), ("a", 30), ("b", 50)], "k string, at long")
    assert rows(slots.pause_length(df, ["k"], "at", 10)) == [("a", 10, 30, 20), ("b", None, 50, None)]


POLLS = "k string, at long, i long, state string, rows long, error string"


def outcome(spark, polls, timeout=900):
    df = spark.createDataFrame([("s", at * SECOND, i, *rest) for i, (at, *rest) in enumerate(polls)], POLLS)
    found = sync.sync_outcome(df, "k", "at", "i", expected_rows=50, timeout_seconds=timeout, slot_micros=20 * SECOND).first()
    return found["outcome"], found["at"] // SECOND if found["at"] is not None else None


def test_sync_waits_for_the_table(spark):
    """Five polls without the table, then 50 rows."""
    missing = [(15 * i, "PROVISIONING", None, "missing") for i in range(5)]
    assert outcome(spark, [*missing, (75, "ONLINE", 50, None)]) == ("ready", 75)
    assert outcome(spark, [(0, "PROVISIONING", 50, None), (15, "ONLINE", 49, None)]) == ("waiting", None)


def test_three_other_errors_end_it(spark):
    bad = ("ONLINE", None, "other")
    assert outcome(spark, [(0, *bad), (15, *bad), (30, *bad)]) == ("error", 30)
    assert outcome(spark, [(0, *bad), (15, *bad), (30, "X", 1, None), (45, *bad), (60, *bad)]) == ("waiting", None)
    assert outcome(spark, [(0, *bad), (15, *bad), (30, "X", None, "missing"), (45, *bad)]) == ("error", 45)


def test_failed_and_timeout(spark):
    assert outcome(spark, [(0, "X", 0, None), (15, "ONLINE_FAILED", 90, None)]) == ("failed", 15)
    assert outcome(spark, [(0, "X", 0, None), (900, "X", 0, None), (915, "X", 0, None), (930, "ONLINE", 50, None)]) == ("timeout", 915)


def test_snapshot_sync_and_freshness(spark, tmp_path, rows):
    """50 products, synced whole; the copy is current until the source moves on."""
    products = spark.range(1, 51).select(F.col("id").alias("product_id"), (100 + F.col("id") * 25).alias("price_cents"))
    store = VersionStore(spark, str(tmp_path / "s"))
    sync.snapshot_sync(products, ["product_id"], store, "catalog", 1, 7)
    assert store.read("catalog").count() == 50 and store.manifest().first()["tag"] == "7"
    with pytest.raises(ValueError):
        sync.snapshot_sync(products.union(products), ["product_id"], store, "catalog", 2, 8)
    newest = spark.createDataFrame([("catalog", 8), ("never", 1)], "name string, version long")
    synced = spark.createDataFrame([("catalog", 7)], "name string, version long")
    assert rows(sync.freshness(newest, synced, ["name"])) == [("catalog", 8, 7, 1, False), ("never", 1, None, 1, False)]


def test_late_writes(spark, rows):
    df = spark.range(1, 8).toDF("id")
    assert rows(sync.late_writes(df, "id", 5)) == [(6,), (7,)]
    assert rows(sync.late_writes(df, "id", df.filter("id < 4").select(F.max("id")))) == [(i,) for i in (4, 5, 6, 7)]


def changes(spark, folder, data):
    df = spark.createDataFrame(data, "k int, v string, ver long, op string")
    df.coalesce(1).write.mode("append").parquet(folder)
    return df.schema


def test_triggered_sync_over_several_runs(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    schema = changes(spark, source, [(1, "a", 1, "u"), (2, "b", 2, "u"), (1, "c", 3, "u")])
    copy = jobs.ChangeLogSync(spark, ["k"], "ver", "op = 'd'", schema, str(tmp_path / "copy"))
    copy.start(jobs.read_files(spark, source, schema)).awaitTermination()
    assert rows(copy.current(), "k", "v") == [(1, "c"), (2, "b")]
    changes(spark, source, [(2, None, 4, "d"), (3, "e", 5, "u")])
    copy.start(jobs.read_files(spark, source, schema)).awaitTermination()
    assert rows(copy.current(), "k", "v") == [(1, "c"), (3, "e")]
    copy.compact()
    assert rows(copy.current(), "k", "v") == [(1, "c"), (3, "e")]
    changes(spark, source, [(3, "f", 6, "u"), (1, "old", 2, "u"), (2, "late", 3, "u")])
    copy.start(jobs.read_files(spark, source, schema)).awaitTermination()
    assert rows(copy.current(), "k", "v") == [(1, "c"), (3, "f")]
    copy.compact()
    assert rows(copy.current(), "k", "v") == [(1, "c"), (3, "f")]


def test_a_replayed_batch_changes_nothing(spark, tmp_path, rows):
    schema = "k int, v string, ver long, op string"
    batch = spark.createDataFrame([(1, "a", 1, "u"), (1, "b", 2, "u")], schema)
    copy = jobs.ChangeLogSync(spark, ["k"], "ver", "op = 'd'", batch.schema, str(tmp_path / "copy"))
    assert copy.current().isEmpty()
    for _ in range(2):
        copy.write_batch(batch, 0)
    assert rows(copy.current(), "k", "v") == [(1, "b")] and spark.read.parquet(f"{copy.root}/changes").count() == 1


def test_continuous_sync(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    schema = changes(spark, source, [(1, "a", 1, "u")])
    copy = jobs.ChangeLogSync(spark, ["k"], "ver", "op = 'd'", schema, str(tmp_path / "copy"))
    running = copy.start(jobs.read_files(spark, source, schema), every="1 second")
    try:
        running.processAllAvailable()
        changes(spark, source, [(1, "b", 2, "u")])
        running.processAllAvailable()
    finally:
        running.stop()
    assert rows(copy.current(), "k", "v") == [(1, "b")]


def events(spark, folder, seconds):
    df = spark.createDataFrame([(i, s) for i, s in seconds], "id int, s long").withColumn("ts", F.timestamp_seconds("s"))
    df.coalesce(1).write.mode("append").parquet(folder)
    return df.schema


def test_resends_count_once_over_batches(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    schema = events(spark, source, [(1, 10), (2, 20), (1, 10)])
    events(spark, source, [(2, 20), (3, 30)])
    stream = jobs.without_resends(jobs.read_files(spark, source, schema, files_per_batch=1), ["id"], "ts", "1 hour")
    assert rows(jobs.drain(stream), "id") == [(1,), (2,), (3,)]


def test_windows_and_sessions_close_behind_the_watermark(spark, tmp_path, rows):
    source = str(tmp_path / "in")
    schema = events(spark, source, [(1, 0), (2, 30), (3, 59), (4, 60)])
    events(spark, source, [(5, 400)])
    stream = jobs.read_files(spark, source, schema, files_per_batch=1)
    windows = jobs.drain(jobs.writes_per_window(stream, "ts", "1 minute", "1 minute"))
    assert rows(windows.select(F.unix_seconds("window_start"), "writes")) == [(0, 3), (60, 1)]
    sessions = jobs.drain(jobs.write_sessions(stream.withColumn("k", F.lit("x")), ["k"], "ts", "40 seconds", "1 minute"))
    assert rows(sessions.select(F.unix_seconds("session_start"), F.unix_seconds("session_end"), "writes")) == [(0, 100, 4)]


def test_streams_read_a_file_or_a_folder_of_parts(spark, rows, tmp_path):
    events = spark.range(200).select("id", F.timestamp_micros(F.col("id") * 7_000_000).alias("ts"))
    events.repartition(5).write.parquet(str(tmp_path / "parts" / "events.parquet"))
    events.coalesce(1).write.parquet(str(tmp_path / "one"))
    file = next((tmp_path / "one").glob("part-*.parquet"))
    (tmp_path / "single").mkdir()
    (tmp_path / "single" / "events.parquet").write_bytes(file.read_bytes())
    counted = lambda df: jobs.writes_per_window(df, "ts", "1 minute", "1 minute")
    for folder in ("parts", "single"):
        stream = jobs.read_files(spark, str(tmp_path / folder), events.schema, "events.parquet")
        assert jobs.drain(stream).count() == 200
        found = jobs.with_open(jobs.drain(counted(stream)), counted(events), ["window_start"])
        assert found.agg(F.sum("writes")).first()[0] == 200 and rows(found) == rows(counted(events))
    with pytest.raises(FileNotFoundError):
        jobs.read_files(spark, str(tmp_path), events.schema, "events.parquet")


def test_the_change_log_compacts_itself(spark, rows, tmp_path):
    schema = "k long, v long, gone boolean"
    copy = jobs.ChangeLogSync(spark, ["k"], "v", "gone", spark.createDataFrame([], schema).schema, str(tmp_path), compact_every=3)
    for batch in range(7):
        copy.write_batch(spark.createDataFrame([(batch % 2, batch, batch == 6)], schema), batch)
    assert copy._finished("base", "through") == [2, 5] and rows(copy.current(), "k", "v") == [(1, 5)]


def test_any_error_counts_as_no_rows(spark, rows):
    polls = spark.createDataFrame([(1, 0, 1, "ONLINE", 90, "other"), (2, 0, 1, "ONLINE", 90, None)],
                                  "sync long, at long, ord long, state string, rows long, error string")
    assert rows(sync.sync_outcome(polls, "sync", "at", "ord", expected_rows=50, timeout_seconds=60), "sync", "outcome") == [
        (1, "waiting"), (2, "ready")]
