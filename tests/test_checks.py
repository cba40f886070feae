import json

import pytest
from pyspark.sql import functions as F

from tableshift.operators import checks, compare, graph, mutate
from tableshift.operators.constraints import ForeignKey, Rules
from tableshift.plans.verify import cutover_gate
from tableshift.sources.sides import Side


def results(spark, data):
    return spark.createDataFrame(data, "check string, status string, detail string, fix string, ord int")


def test_records(spark, rows):
    df = spark.createDataFrame([("a", "warn", "  x\n\t y z ", "do it"), ("b", "pass", "d" * 600, "do it"), ("c", "fail", None, "now")],
                               "check string, status string, detail string, fix string")
    found = rows(checks.records(df))
    assert found[0] == ("a", "warn", "x y z", "do it")
    assert found[1] == ("b", "pass", "d" * 500, "") and found[2] == ("c", "fail", "", "now")


def test_rerun_replaces(spark, rows):
    df = results(spark, [("a", "fail", "", "", 1), ("b", "pass", "", "", 2), ("a", "pass", "", "", 3)])
    assert rows(checks.latest_results(df), "check", "status", "ord") == [("a", "pass", 3), ("b", "pass", 2)]


@pytest.mark.parametrize("statuses, expected", [
    ([], "not ready"), (["pass"], "ready"), (["pass", "warn", "skip"], "ready with notes"), (["skip"], "ready"),
    (["fail", "warn"], "not ready")])
def test_verdict(spark, statuses, expected):
    df = spark.createDataFrame([(s,) for s in statuses], "status string")
    assert checks.verdict(df).first()["verdict"] == expected


def test_skips_spread_and_warnings_block(spark, rows):
    outcomes = spark.createDataFrame([(c, "pass") for c in "bdefgh"] + [("a", "fail"), ("c", "warn")], "check string, status string")
    needs = spark.createDataFrame([("b", "a"), ("d", "b"), ("d", "e"), ("f", "c"), ("g", "nobody"), ("h", "e"), ("d", "a")],
                                  "check string, needed string")
    assert rows(checks.with_skips(outcomes, needs)) == [
        ("a", "fail", ""), ("b", "skip", "needs: a"), ("c", "warn", ""), ("d", "skip", "needs: a, b"), ("e", "pass", ""),
        ("f", "skip", "needs: c"), ("g", "skip", "needs: nobody"), ("h", "pass", "")]


def test_skips_survive_a_loop(spark, rows):
    outcomes = spark.createDataFrame([("a", "pass"), ("b", "pass"), ("c", "fail")], "check string, status string")
    needs = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c")], "check string, needed string")
    assert rows(checks.with_skips(outcomes, needs), "check", "status") == [("a", "skip"), ("b", "skip"), ("c", "fail")]


def gate_of(spark, new_orders, **changes):
    orders = spark.range(1, 101).select(F.col("id").alias("order_id"), F.lit(1999).alias("cents"))
    old = Side.of("old", {"app": {"orders": orders}})
    new = Side.of("new", {"app": {"orders": new_orders(orders)}})
    last = spark.createDataFrame([("orders_seq", 100)], "sequence string, last_value long")
    parts = {
        "sequences": compare.sequence_compare(last, last.withColumn("newest_id", F.lit(100))),
        "ledger_newest": spark.createDataFrame([(3,)], "v int"),
        "access": spark.createDataFrame([(True,)], "can_read boolean"),
        "sync": None,
        "smoke": mutate.smoke_write(new.table("app", "orders"), spark.createDataFrame(
            [(-1, 100)], "order_id long, cents int").select(*new.table("app", "orders").columns), ["order_id"]),
        **changes}
    return cutover_gate(old, new, watermarks={("app", "orders"): "order_id"}, expected_version=3, **parts)


def test_gate_seven_of_seven(spark):
    assert tuple(checks.gate_summary(gate_of(spark, lambda o: o)).first()) == (7, 7, True)


def test_gate_notices(spark, rows):
    def failed(gated):
        return rows(gated.filter("not passed"), "check")
    assert failed(gate_of(spark, lambda o: o.filter("order_id <> 5"))) == [("schema and tables identical",), ("watermark matches",)]
    assert failed(gate_of(spark, lambda o: o.withColumn("cents", F.col("cents").cast("long")))) == [("schema and tables identical",)]
    assert failed(gate_of(spark, lambda o: o, ledger_newest=spark.createDataFrame([(2,)], "v int"))) == [("migration history carried over",)]
    nobody = spark.createDataFrame([], "can_read boolean")
    assert failed(gate_of(spark, lambda o: o, access=nobody)) == [("reader can read every table",)]
    behind = spark.createDataFrame([(False,)], "current boolean")
    assert failed(gate_of(spark, lambda o: o, sync=behind)) == [("sync current or unused",)]


def test_report(spark, rows):
    df = results(spark, [("a", "pass", 'say "hi"', "", 1), ("b", "warn", "x", "fix", 2)])
    document = json.loads(checks.report_documents(df).first()["document"])
    assert document["verdict"] == "ready with notes" and document["results"][0]["detail"] == 'say "hi"'
    assert rows(checks.read_report_lines(checks.report_lines(df))) == [("a", "pass", 'say "hi"', ""), ("b", "warn", "x", "fix")]
    many = df.withColumn("run", F.col("check")).unionByName(df.withColumn("run", F.lit("b")))
    per_run = {r["run"]: json.loads(r["document"]) for r in checks.report_documents(many, ["run"]).collect()}
    assert [len(per_run[k]["results"]) for k in "ab"] == [1, 3] and per_run["a"]["verdict"] == "ready"


def test_runner_skips_without_running(spark, rows):
    ran = []

    def body(name, status):
        def run():
            ran.append(name)
            return spark.createDataFrame([(status, f"{name} ran")], "status string, detail string")
        return run
    listed = [checks.Check("d", body("d", "pass"), "x", ["b", "c"]), checks.Check("a", body("a", "pass")),
              checks.Check("b", body("b", "fail"), "mend b", ["a"]), checks.Check("c", body("c", "pass"), "", ["a"]),
              checks.Check("e", body("e", "pass"), "", ["d"]), checks.Check("f", body("f", "odd")), checks.Check("g", body("g", "pass"), "", ["nobody"]),
              checks.Check("l1", body("l1", "pass"), "", ["l2"]), checks.Check("l2", body("l2", "pass"), "", ["l1"]),
              checks.Check("z", lambda: 1 / 0)]
    done = checks.run_checks(spark, listed)
    assert sorted(ran) == ["a", "b", "c", "f"]
    assert rows(done, "check", "status") == [("a", "pass"), ("b", "fail"), ("c", "pass"), ("d", "skip"), ("e", "skip"), ("f", "fail"),
                                             ("g", "skip"), ("l1", "skip"), ("l2", "skip"), ("z", "fail")]
    assert done.filter("check = 'd'").first()["detail"] == "needs: b" and done.filter("seconds is null or seconds < 0").isEmpty()
    again = checks.run_checks(spark, [checks.Check("b", body("b", "pass"))], earlier=done)
    assert again.count() == 10 and again.filter("check = 'b'").first()["status"] == "pass"


def test_gate_scans_each_table_once(spark, tmp_path):
    orders = spark.range(1, 101).select(F.col("id").alias("order_id"), F.lit(1999).alias("cents"))
    orders.write.parquet(str(tmp_path / "o"))
    side = Side.of("s", {"app": {"orders": spark.read.parquet(str(tmp_path / "o"))}})
    gated = cutover_gate(side, side, watermarks={("app", "orders"): "order_id"}, expected_version=3, sync=None,
                         sequences=spark.sql("select true ok"), ledger_newest=spark.sql("select 3 v"),
                         access=spark.sql("select true can_read"), smoke=spark.sql("select true smoke_ok"))
    assert checks.gate_summary(gated).first()["go"]
    assert str(tmp_path) not in gated._jdf.queryExecution().optimizedPlan().toString()  # only written profiles are read
    rules = Rules(foreign_keys=[ForeignKey(["order_id"], "x", ["y"])])
    declared = [compare.declared_rules(spark, {"orders": orders.schema}, {"orders": r}) for r in (rules, Rules())]
    dropped = compare.declared_diff(*declared)
    assert [(r["kind"], r["status"]) for r in dropped.filter("status <> 'same'").collect()] == [("foreign key", "missing")]
    failed = cutover_gate(side, side, watermarks={("app", "orders"): "order_id"}, expected_version=3, sync=None, declarations=dropped,
                          sequences=spark.sql("select true ok"), ledger_newest=spark.sql("select 3 v"),
                          access=spark.sql("select true can_read"), smoke=spark.sql("select true smoke_ok"))
    assert failed.filter("not passed").count() == 1


def test_lineage_of_a_long_chain(spark, rows):
    tree = spark.range(21).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    found = {r["node"]: r for r in graph.lineage(tree, "id", "parent").collect()}
    assert found[20]["depth"] == 20 and found[20]["root"] == 0 and found[3]["path"] == "0/1/2/3"
    waves = rows(graph.teardown_waves(graph.lineage(tree, "id", "parent")))
    assert waves[0] == (0, 0, 20, 0) and [w for w in waves if w[0] == 20] == [(20, 20, 0, 20)]


def test_lineage_of_20000_levels(spark):
    tree = spark.range(20_000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    found = graph.lineage(tree, "id", "parent", with_path=False)
    assert found.filter("depth = node and root = 0 and path is null").count() == 20_000


def test_lineage_of_a_wide_tree(spark):
    tree = spark.range(2000).select("id", F.when(F.col("id") > 0, F.lit(0).cast("long")).alias("parent"))
    assert graph.lineage(tree, "id", "parent").filter("depth = 1 and path = concat('0/', node)").count() == 1999


def test_broken_trees_raise(spark):
    with pytest.raises(ValueError, match="does not exist"):
        graph.lineage(spark.createDataFrame([(1, None), (2, 7)], "id int, parent int"), "id", "parent")
    with pytest.raises(ValueError, match="loop"):
        graph.lineage(spark.createDataFrame([(1, 2), (2, 1)], "id int, parent int"), "id", "parent")
    ring = spark.range(2000).select("id", ((F.col("id") + 1) % 2000).alias("parent"))
    with pytest.raises(ValueError, match="loop"):
        graph.lineage(ring, "id", "parent")


def test_reach_keeps_labels_apart(spark, rows):
    seeds = spark.createDataFrame([("a", "read"), ("b", "write"), ("a", "read")], "n string, p string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "source string, target string")
    assert rows(graph.reach(seeds, edges, "n", ["p"])) == [(n, p) for n in "abc" for p in ("read", "write")]
