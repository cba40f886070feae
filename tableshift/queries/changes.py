"""Table changes: inserts, updates, generated ids, migrations, reconciling a branch, change feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableshift.operators import diff, mutate, reconcile
from tableshift.plans import migrate as mig
from tableshift.queries import sqltext as q
from tableshift.queries.registry import query
from tableshift.sources import fixtures as fx
from tableshift.sources.versions import VersionStore

MIGRATIONS = {1: "customers", 2: "orders", 3: "coupons", 4: "feature flags", 5: "loyalty"}


@query("""
with batch as (select 'C' || o_custkey as code, 1 + o_orderkey % 90 as percent_off, o_orderkey from orders),
target as (select 'C' || c_custkey as code, 50 as percent_off from customer where c_acctbal > 5000)
select code, percent_off from target
union all
select code, arg_min(percent_off, o_orderkey) from batch where code not in (select code from target) group by code""")
def insert_if_absent(t):
    batch = t["orders"].select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("code"),
                               (1 + F.col("o_orderkey") % 90).alias("percent_off"), "o_orderkey")
    target = t["customer"].filter("c_acctbal > 5000").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("code"), F.lit(50).cast("bigint").alias("percent_off"))
    return mutate.insert_if_absent(target, batch, ["code"], ["o_orderkey"])


@query("""
select o_orderkey, case when o_orderkey % 97 = 0 and o_orderstatus <> 'F' then 'FALL10' when o_orderstatus = 'F' then 'OLD' end
  as coupon_code from orders""")
def predicate_update(t):
    rows = t["orders"].select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "OLD").alias("coupon_code"))
    wanted = (F.col("o_orderkey") % 97 == 0) & F.col("coupon_code").isNull()
    return mutate.predicate_update(rows, wanted, {"coupon_code": F.lit("FALL10")})


@query("""
with updates as (select o_custkey, arg_max(o_orderpriority, o_orderkey) as p from orders group by 1)
select c_custkey, c_name, case when o_custkey is not null then p else c_mktsegment end as c_mktsegment
from customer left join updates on o_custkey = c_custkey""")
def keyed_update(t):
    rows = t["customer"].select("c_custkey", "c_name", "c_mktsegment")
    updates = t["orders"].select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("c_mktsegment"),
                                 "o_orderkey")
    return mutate.keyed_update(rows, updates, ["c_custkey"], ["o_orderkey"])


@query("""
select (select max(o_orderkey) from orders) + row_number() over (order by event_id) as order_id, event_id, user_id, event_type
from events""")
def allocate_ids(t):
    """New orders continue after the newest id, in the order of the events that caused them."""
    batch = t["events"].select("event_id", "user_id", "event_type")
    return mutate.allocate_ids(batch, ["event_id"], "order_id", t["orders"].select(F.max("o_orderkey")))


@query("""
select count(*) as rows_before, count(*) + (select count(*) from region) as rows_with_probe, count(*) as rows_after,
       true as smoke_ok from orders""")
def smoke_write(t):
    """A probe row per region under negative keys, written beside the orders and never published."""
    orders = t["orders"]
    probe = t["region"].select((-1 - F.col("r_regionkey")).cast("bigint").alias("o_orderkey"),
                               F.lit(1).cast("bigint").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
                               F.lit(100.0).alias("o_totalprice"), F.lit(None).cast("timestamp_ntz").alias("o_orderdate"),
                               F.lit("5-LOW").alias("o_orderpriority"))
    return mutate.smoke_write(orders, probe, ["o_orderkey"])


_LEDGER = "(select distinct o_custkey as database, cast(substr(o_orderpriority, 1, 1) as int) as version from orders)"


def _ledger(t):
    return t["orders"].select(F.col("o_custkey").alias("database"),
                              F.left("o_orderpriority", F.lit(1)).cast("int").alias("version"))


@query(f"""
with steps(version, description) as (values (1, 'customers'), (2, 'orders'), (3, 'coupons'), (4, 'feature flags'), (5, 'loyalty')),
wanted as (select c_custkey as database, case when c_acctbal > 0 then 5 else 3 end as up_to from customer)
select database, version, description from wanted join steps on version <= up_to
where not exists (select 1 from {_LEDGER} l where l.database = wanted.database and l.version = steps.version)""")
def pending_migrations(t):
    """Every customer is a database; the priorities of its orders are the versions its ledger holds."""
    databases = t["customer"].select(F.col("c_custkey").alias("database"),
                                     F.when(F.col("c_acctbal") > 0, 5).otherwise(3).alias("up_to"))
    return mig.pending_migrations(databases, MIGRATIONS, _ledger(t))


@query(f"""
select database, string_agg(cast(version as varchar), ',' order by version) as history, max(version) as newest,
       string_agg(cast(version as varchar), ',' order by version) = '1,2,3,4,5' as as_expected
from {_LEDGER} group by 1""")
def migration_ledger(t):
    return mig.ledger_history(_ledger(t), list(MIGRATIONS))


@query("""
select o_orderkey, o_custkey, cast(null as varchar) as coupon_code,
       (select count(*) from part) as coupons, '1,2,3' as ledger from orders""")
def add_column(t):
    """Three migrations run against a store: the third adds a table and a nullable column to the orders."""
    steps = [
        mig.Migration(1, "customers", lambda tables: {"customer": t["customer"].select("c_custkey", "c_name")}),
        mig.Migration(2, "orders", lambda tables: {"orders": t["orders"].select("o_orderkey", "o_custkey")}),
        mig.Migration(3, "coupons", lambda tables: {
            "coupons": t["part"].select(F.col("p_partkey").alias("code"), F.col("p_size").alias("percent_off")),
            "orders": mutate.add_column(tables["orders"], "coupon_code", "string")}),
    ]
    store = VersionStore(t.spark)
    ledger = mig.migrate(store, steps, up_to=3, now=fx.NOW_MICROS)
    return store.read("orders").select(
        "o_orderkey", "o_custkey", "coupon_code",
        store.read("coupons").select(F.count(F.lit(1))).scalar().alias("coupons"),
        F.lit(",".join(str(v) for v in ledger)).alias("ledger"))


_BRANCH_CODES = "(select p_brand || '/' || p_name as code, max(p_size) as percent_off from part group by 1)"
_PROD_CODES = "(select distinct p_brand || '/' || p_name as code from part where p_size <= 25)"


def _codes(t):
    parts = t["part"].withColumn("code", F.concat_ws("/", "p_brand", "p_name"))
    branch = parts.groupBy("code").agg(F.max("p_size").alias("percent_off"))
    return parts, branch, parts.filter("p_size <= 25").select("code")


@query(f"select code, percent_off from {_BRANCH_CODES} where code not in (select code from {_PROD_CODES})")
def branch_only_rows(t):
    _, branch, production = _codes(t)
    return reconcile.branch_only(branch, production, ["code"])


@query(f"""
select l_orderkey, l_linenumber, l_partkey, p_brand || '/' || p_name as code from lineitem join part on p_partkey = l_partkey
where p_brand || '/' || p_name not in (select code from {_PROD_CODES})""")
def branch_edits(t):
    """Lines that use a code only the branch has."""
    parts, branch, production = _codes(t)
    own = reconcile.branch_only(branch, production, ["code"])
    # Parts are matched with the codes first: the lines then meet each part once, whatever their skew.
    using = reconcile.rows_using(parts.select("p_partkey", "code"), "code", own, "code")
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    return lines.join(using, "p_partkey").select("l_orderkey", "l_linenumber", F.col("p_partkey").alias("l_partkey"), "code")


_BRANCH = """(
  select o_orderkey, case when o_orderpriority = '1-URGENT' then o_custkey + 7 else o_custkey end as o_custkey,
         case when o_orderpriority = '2-HIGH' then 'X' else o_orderstatus end as o_orderstatus
  from orders where not (o_orderpriority = '5-LOW' and o_orderstatus = 'F')
  union all select o_orderkey + 2000000000000, o_custkey, 'N' from orders where o_totalprice > 400000)"""


@query(f"""
select key as o_orderkey, action, conflicts,
       case when action = 'take' or (action = 'merge' and r.o_custkey is distinct from b.o_custkey) then r.o_custkey else t.o_custkey end as o_custkey,
       case when action = 'take' or (action = 'merge' and r.o_orderstatus is distinct from b.o_orderstatus) then r.o_orderstatus else t.o_orderstatus end as o_orderstatus
from (
  select *, case when conflicts <> '' then 'conflict' when not r_here and not t_here then 'gone'
    when r_here and t_here and r.o_custkey = t.o_custkey and r.o_orderstatus = t.o_orderstatus then 'same'
    when b_here and not r_here then 'delete'
    when r_moved and not t_moved then 'take' when r_moved then 'merge'
    when not t_here then 'gone' else 'keep' end as action
  from (
    select *, case
      when b_here and r_here and t_here then concat_ws(',',
        case when r.o_custkey <> b.o_custkey and t.o_custkey <> b.o_custkey and r.o_custkey <> t.o_custkey then 'o_custkey' end,
        case when r.o_orderstatus <> b.o_orderstatus and t.o_orderstatus <> b.o_orderstatus and r.o_orderstatus <> t.o_orderstatus then 'o_orderstatus' end)
      when not b_here and r_here and t_here and (r.o_custkey <> t.o_custkey or r.o_orderstatus <> t.o_orderstatus) then '*inserted twice*'
      when b_here and not r_here and t_here and t_moved then '*deleted and edited*'
      when b_here and r_here and not t_here and r_moved then '*edited and deleted*'
      else '' end as conflicts
    from (
      select coalesce(b.o_orderkey, r.o_orderkey, t.o_orderkey) as key, b, r, t,
             b.o_orderkey is not null as b_here, r.o_orderkey is not null as r_here, t.o_orderkey is not null as t_here,
             r.o_custkey is distinct from b.o_custkey or r.o_orderstatus is distinct from b.o_orderstatus as r_moved,
             t.o_custkey is distinct from b.o_custkey or t.o_orderstatus is distinct from b.o_orderstatus as t_moved
      from (select o_orderkey, o_custkey, o_orderstatus from orders) b
      full join {_BRANCH} r on b.o_orderkey = r.o_orderkey
      full join (select o_orderkey, o_custkey, o_orderstatus from {q.DRIFTED_ORDERS}) t
        on coalesce(b.o_orderkey, r.o_orderkey) = t.o_orderkey)))""")
def three_way(t):
    """A branch's edits against production that moved on: taken, merged, or reported as conflicts."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    o, priority = t["orders"], F.col("o_orderpriority")
    edited = (o.filter(~((priority == "5-LOW") & (F.col("o_orderstatus") == "F")))
              .withColumn("o_custkey", F.when(priority == "1-URGENT", F.col("o_custkey") + 7).otherwise(F.col("o_custkey")))
              .withColumn("o_orderstatus", F.when(priority == "2-HIGH", "X").otherwise(F.col("o_orderstatus"))))
    added = (o.filter("o_totalprice > 400000").withColumn("o_orderkey", F.col("o_orderkey") + 2_000_000_000_000)
             .withColumn("o_orderstatus", F.lit("N")))
    branch = edited.unionByName(added)
    return reconcile.three_way(o.select(columns), branch.select(columns), fx.drifted_orders(t).select(columns), ["o_orderkey"])


@query(f"""
with d as (
  select coalesce(a.o_orderkey, b.o_orderkey) as k, a.o_orderkey as ak, b.o_orderkey as bk, a.o_custkey as ac, b.o_custkey as bc,
         a.o_orderstatus as ast, b.o_orderstatus as bst
  from orders a full join {q.DRIFTED_ORDERS} b on a.o_orderkey = b.o_orderkey)
select 'insert' as change_type, cast(2 as bigint) as version, k as o_orderkey, bc as o_custkey, bst as o_orderstatus from d where ak is null
union all select 'delete', 2, k, ac, ast from d where bk is null
union all select 'update_pre', 2, k, ac, ast from d where ak = bk and (ac <> bc or ast <> bst)
union all select 'update_post', 2, k, bc, bst from d where ak = bk and (ac <> bc or ast <> bst)""")
def change_feed(t):
    columns = ["o_custkey", "o_orderstatus"]
    found = diff.row_diff(t["orders"], fx.drifted_orders(t), ["o_orderkey"], columns, keep_values=True)
    return diff.change_rows(found, ["o_orderkey"], columns, 2)


@query("""
with changes as (select user_id, arg_max(event_type, event_id) as event_type, max(event_id) as version from events group by 1),
target as (select c_custkey as user_id, c_mktsegment as event_type, cast(-1 as bigint) as version from customer)
select user_id, event_type, version from target where user_id not in (select user_id from changes)
union all select user_id, event_type, version from changes where event_type <> 'error'""")
def cdc_apply(t):
    """The events are row changes by user: the newest wins and an error is a delete."""
    target = t["customer"].select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("event_type"),
                                  F.lit(-1).cast("bigint").alias("version"))
    changes = t["events"].select("user_id", "event_type", F.col("event_id").alias("version"))
    return mutate.apply_changes(target, changes, ["user_id"], "version", F.col("event_type") == "error")
