"""Checks: records, reruns, dependencies, verdicts, the gate before a switch, and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableshift.operators import checks, compare, mutate
from tableshift.operators.sync import freshness
from tableshift.plans import verify
from tableshift.queries import sqltext as q
from tableshift.queries.registry import query
from tableshift.sources import fixtures as fx
from tableshift.sources.sides import Side, tagged_union

_STATUS = "case event_type when 'error' then 'fail' when 'purchase' then 'warn' when 'signup' then 'skip' else 'pass' end"
_RUNS = f"(select user_id as \"check\", {_STATUS} as status, props as detail, event_id as ord from events)"


def _runs(t):
    """Every event is one run of the check named by its user."""
    return t["events"].select(F.col("user_id").alias("check"), F.expr(_STATUS).alias("status"),
                              F.col("props").alias("detail"), F.col("event_id").alias("ord"))


@query(f"""select "check", arg_max(status, ord) as status, arg_max(detail, ord) as detail, max(ord) as ord from {_RUNS} group by 1""")
def latest_results(t):
    return checks.latest_results(_runs(t))


@query(f"""
select "check" % 3 as "database", count(*) filter (where status = 'pass') as n_pass, count(*) filter (where status = 'warn') as n_warn,
       count(*) filter (where status = 'fail') as n_fail, count(*) filter (where status = 'skip') as n_skip from {_RUNS} group by 1""")
def status_counts(t):
    return checks.status_counts(_runs(t).withColumn("database", F.col("check") % 3), ["database"])


@query(f"""
select *, case when n_fail > 0 then 'not ready' when n_warn > 0 then 'ready with notes' else 'ready' end as verdict from (
  select "check" // 5 as "database", count(*) filter (where status = 'pass') as n_pass, count(*) filter (where status = 'warn') as n_warn,
         count(*) filter (where status = 'fail') as n_fail, count(*) filter (where status = 'skip') as n_skip
  from (select "check", arg_max(status, ord) as status from {_RUNS} group by 1) group by 1)""")
def verdict(t):
    """The verdict of each group of five checks, from their newest runs."""
    latest = checks.latest_results(_runs(t)).withColumn("database", F.floor(F.col("check") / 5))
    return checks.verdict(latest, ["database"])


_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(f"""
select conv_id || '/' || turn as "check", case role when 'user' then 'fail' when 'system' then 'warn' else 'pass' end as status,
       left(trim(regexp_replace(text, '{_SPACE}', ' ', 'g'), ' '), 500) as detail,
       case when role in ('user', 'system') then 'ask ' || role else '' end as fix from conversations""")
def check_results(t):
    """Every message is the outcome of one check."""
    results = t["conversations"].select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("check"),
        F.when(F.col("role") == "user", "fail").when(F.col("role") == "system", "warn").otherwise("pass").alias("status"),
        F.col("text").alias("detail"), F.concat(F.lit("ask "), "role").alias("fix"))
    return checks.records(results)


_OUTCOME = "case when c_acctbal < -960 then 'fail' when c_acctbal < -920 then 'warn' else 'pass' end"
_NEEDS = """(select c_custkey as k, c_custkey // 2 as needed from customer where c_custkey > 0
             union select c_custkey, c_custkey // 3 from customer where c_custkey > 0
             union select c_custkey, -1 - c_custkey from customer where c_acctbal > 9950)"""


@query(f"""
with recursive outcome as (select c_custkey as k, {_OUTCOME} as status from customer),
bad as (
  select k from outcome where status <> 'pass'
  union select needed from {_NEEDS} n where needed not in (select k from outcome)
  union select n.k from {_NEEDS} n join bad on n.needed = bad.k),
unmet as (select k, 'needs: ' || string_agg(cast(needed as varchar), ', ' order by cast(needed as varchar)) as detail
          from {_NEEDS} where needed in (select k from bad) group by 1)
select o.k as "check", case when detail is not null then 'skip' else status end as status, coalesce(detail, '') as detail
from outcome o left join unmet u on u.k = o.k""")
def dependency_skips(t):
    """Every customer is a check that needs those at half and a third of its key; some need one that never ran."""
    key, people = F.col("c_custkey"), t["customer"]
    outcomes = people.select(key.alias("check"), F.expr(_OUTCOME).alias("status"))
    needs = (people.filter(key > 0).select(key.alias("check"), F.floor(key / 2).alias("needed"))
             .union(people.filter(key > 0).select(key.alias("check"), F.floor(key / 3).alias("needed")))
             .union(people.filter("c_acctbal > 9950").select(key.alias("check"), (-1 - key).alias("needed"))))
    return checks.with_skips(outcomes, needs)


_GATE_NAMES = ("schema and tables identical", "watermark matches", "sequences carried over",
               "migration history carried over", "reader can read every table", "sync current or unused", "smoke test")


def _gate(t, new: Side):
    name = F.concat(F.lit("status_"), "o_orderstatus").alias("sequence")
    old = Side.of("old", {"sales": {"customer": t["customer"], "orders": t["orders"]}})

    def sequence(side):
        return side.table("sales", "orders").groupBy(name).agg(F.max("o_orderkey").alias("last_value"))
    seqs = compare.sequence_compare(sequence(old), sequence(new).withColumn("newest_id", F.col("last_value")))
    ledger = new.table("sales", "orders").select(F.max(F.left("o_orderpriority", F.lit(1)).cast("int")))
    access = new.table("sales", "customer").select(F.col("c_acctbal").isNotNull().alias("can_read"))
    probe = (t["region"].select((-1 - F.col("r_regionkey")).cast("bigint").alias("o_orderkey"),
                                *[F.lit(None).cast(f.dataType).alias(f.name) for f in t["orders"].schema.fields[1:]]))

    def synced(side):
        return side.table("sales", "orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("version"))
    return verify.cutover_gate(old, new, watermarks={("sales", "orders"): "o_orderkey"}, sequences=seqs,
                               ledger_newest=ledger, expected_version=5, access=access,
                               sync=freshness(synced(old), synced(new), ["o_custkey"]),
                               smoke=mutate.smoke_write(new.table("sales", "orders"), probe, ["o_orderkey"]))


def _gate_sql(side: str, orders: str, customer: str) -> str:
    same = " and ".join(f"not exists ((select * from {a} except all select * from {b}) union all "
                        f"(select * from {b} except all select * from {a}))" for a, b in (("orders", orders), ("customer", customer)))
    marks = f"(select (max(o_orderkey), count(*)) from orders) = (select (max(o_orderkey), count(*)) from {orders})"
    seqs = (f"not exists (select 1 from (select o_orderstatus as s, max(o_orderkey) as m from orders group by 1) a full join "
            f"(select o_orderstatus as s, max(o_orderkey) as m from {orders} group by 1) b using (s) where a.m is distinct from b.m)")
    ledger = f"(select max(cast(left(o_orderpriority, 1) as int)) from {orders}) = 5"
    access = f"(select bool_and(c_acctbal is not null) from {customer})"
    sync = (f"not exists (select 1 from (select o_custkey as k, max(o_orderkey) as m from orders group by 1) a left join "
            f"(select o_custkey as k, max(o_orderkey) as m from {orders} group by 1) b using (k) where a.m is distinct from b.m)")
    conditions = (same, marks, seqs, ledger, access, sync, "true")
    return " union all ".join(f"select '{side}' as side, '{n}' as \"check\", {c} as passed" for n, c in zip(_GATE_NAMES, conditions))


@query(_gate_sql("clean", "orders", "customer") + " union all " + _gate_sql("drifted", q.DRIFTED_ORDERS, q.DRIFTED_CUSTOMER))
def cutover_gate(t):
    """The seven conditions against a faithful copy and against a drifted one."""
    clean = Side.of("clean", {"sales": {"customer": t["customer"], "orders": t["orders"]}})
    drifted = Side.of("drifted", {"sales": {"customer": fx.drifted_customer(t), "orders": fx.drifted_orders(t)}})
    return tagged_union({"clean": _gate(t, clean), "drifted": _gate(t, drifted)}, tag="side")


@query(f"""
select "check", '{{"check":"' || "check" || '","status":"' || status || '","detail":' || to_json(detail) || ',"fix":"run ' || "check" || '"}}'
         as document, status as status_back, detail as detail_back
from (select cast("check" as varchar) as "check", arg_max(status, ord) as status, arg_max(detail, ord) as detail from {_RUNS} group by 1)""")
def report_json(t):
    """The newest result of every check as JSON, and what reading it back gives."""
    latest = checks.latest_results(_runs(t)).select(
        F.col("check").cast("string").alias("check"), "status", "detail",
        F.concat(F.lit("run "), F.col("check").cast("string")).alias("fix"))
    lines = checks.report_lines(latest)
    back = checks.read_report_lines(lines).select("check", F.col("status").alias("status_back"), F.col("detail").alias("detail_back"))
    return lines.join(back, "check")


@query(f"""
with latest as (select "check", arg_max(status, ord) as status, arg_max(detail, ord) as detail from {_RUNS} group by 1)
select "check" // 5 as "database", '{{"verdict":"' || case when bool_or(status = 'fail') then 'not ready' when bool_or(status = 'warn')
    then 'ready with notes' else 'ready' end || '","results":[' || string_agg('{{"check":"' || "check" || '","status":"' || status
    || '","detail":' || to_json(detail) || ',"fix":"run ' || "check" || '"}}', ',' order by cast("check" as varchar)) || ']}}' as document
from latest group by 1""")
def report_verdict(t):
    """Verdict and newest results of each group of five checks as one document."""
    latest = checks.latest_results(_runs(t)).select(
        F.floor(F.col("check") / 5).alias("database"), F.col("check").cast("string").alias("check"), "status", "detail",
        F.concat(F.lit("run "), F.col("check").cast("string")).alias("fix"))
    return checks.report_documents(latest, ["database"])


@query("""
with a as (select count(*) as n from orders where o_custkey not in (select c_custkey from customer)),
b as (select count(*) as n from orders where o_totalprice < 1000), c as (select count(*) as n from customer where c_acctbal < 0)
select 'orders have customers' as "check", case when n = 0 then 'pass' else 'fail' end as status, n || ' rows' as detail,
    case when n = 0 then '' else 'load customers first' end as fix from a
union all select 'prices in range', case when n = 0 then 'pass' else 'warn' end, n || ' rows', case when n = 0 then '' else 'look at them' end from b
union all select 'balances', case when n = 0 then 'pass' else 'fail' end, n || ' rows', case when n = 0 then '' else 'ask for money' end from c
union all select 'ready to bill', case when c.n = 0 then 'pass' else 'skip' end,
    case when c.n = 0 then '0 rows' else 'needs: balances' end, '' from c""")
def check_run(t):
    """Four checks over orders and customers; the last one needs two of the others and is not run without them."""
    def counted(df, otherwise):
        n = F.count(F.lit(1))
        return lambda: df.agg(F.when(n == 0, "pass").otherwise(otherwise).alias("status"), F.concat(n.cast("string"), F.lit(" rows")).alias("detail"))
    orders, people = t["orders"], t["customer"]
    lost = orders.join(people, F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    done = checks.run_checks(t.spark, [
        checks.Check("ready to bill", counted(people.filter("c_custkey is null"), "fail"), "", ["orders have customers", "balances"]),
        checks.Check("orders have customers", counted(lost, "fail"), "load customers first"),
        checks.Check("prices in range", counted(orders.filter("o_totalprice < 1000"), "warn"), "look at them"),
        checks.Check("balances", counted(people.filter("c_acctbal < 0"), "fail"), "ask for money")])
    return done.select("check", "status", "detail", "fix")
