"""Reading: parameterised and many-database scans, listings, branch views, summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableshift.operators.mutate import seed_if_empty
from tableshift.queries import sqltext as q
from tableshift.queries.registry import query
from tableshift.sources import fixtures as fx
from tableshift.sources import sides


@query("""
select o_orderkey, o_custkey, o_totalprice from orders
where o_orderstatus in ('O', 'P') and not o_totalprice <= 100000 and o_orderpriority like '%-URGENT' and o_custkey is not null""")
def param_scan(t):
    return sides.scan(
        t.spark,
        "select o_orderkey, o_custkey, o_totalprice from {orders} where array_contains(:states, o_orderstatus) "
        "and not o_totalprice <= :least and o_orderpriority like :pattern and o_custkey is not null",
        {"states": F.array(F.lit("O"), F.lit("P")), "least": 100000, "pattern": "%-URGENT"}, orders=t["orders"])


@query(f"""
select 'new' as database, o_orderkey, o_custkey, o_totalprice from {q.DRIFTED_ORDERS}
union all select 'old', o_orderkey, o_custkey, o_totalprice from orders""")
def multi_db_scan(t):
    frames = {"old": t["orders"], "new": fx.drifted_orders(t)}
    return sides.tagged_union({n: df.select("o_orderkey", "o_custkey", "o_totalprice") for n, df in frames.items()})


@query("""
select c_custkey * 5 + i as order_id, c_custkey as customer_id, 500 + ((c_custkey * 5 + i) * 37) % 20000 as amount_cents,
       'Customer ' || c_custkey as name, 'customer' || c_custkey || '@example.com' as email
from customer, generate_series(1, 5) as s(i)""")
def seed_series(t):
    """Five seeded orders for every customer, loaded because the target is still empty."""
    key, g = F.col("c_custkey"), F.col("order_id")
    seeds = (t["customer"].withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(5))))
             .withColumn("order_id", key * 5 + F.col("i"))
             .select("order_id", key.alias("customer_id"), (500 + g * 37 % 20000).alias("amount_cents"),
                     F.concat(F.lit("Customer "), key.cast("string")).alias("name"),
                     F.concat(F.lit("customer"), key.cast("string"), F.lit("@example.com")).alias("email")))
    return seed_if_empty(t.spark.createDataFrame([], seeds.schema), seeds)


@query(f"select database, count(*) as entries from {q.LISTING} where database not in ('Brand#1', 'Brand#2') group by 1")
def list_databases(t):
    return sides.databases_of(fx.catalog_listing(t), skip=("Brand#1", "Brand#2"))


@query(f"""select database, "table" from {q.LISTING} where schema = 'ECONOMY' and kind = 'BASE TABLE'""")
def list_tables(t):
    return sides.base_tables(fx.catalog_listing(t), "ECONOMY")


@query(f"""
with wanted as (select distinct database from {q.LISTING} union select c_name from customer),
held as (select database, count(*) as n from {q.LISTING} where schema = 'ECONOMY' and kind = 'BASE TABLE' group by 1)
select wanted.database, coalesce(n, 0) as tables, coalesce(n, 0) > 0 as has_tables from wanted left join held using (database)""")
def has_tables(t):
    listing = fx.catalog_listing(t)
    wanted = listing.select("database").union(t["customer"].select("c_name")).distinct()
    return sides.with_has_tables(wanted, listing, "ECONOMY")


@query("""
select (select count(*) from customer) as customers, (select count(*) from orders) as orders,
       (select max(o_orderkey) from orders) as newest_order,
       (select count(*) from orders where o_orderpriority = '1-URGENT') as urgent,
       (select string_agg(s, ', ' order by s) from (select distinct o_orderstatus as s from orders)) as states""")
def scalar_summary(t):
    """Counts of several tables in one row, with an ordered list of the few distinct states."""
    orders = t["orders"]
    states = orders.select(F.col("o_orderstatus").alias("s")).distinct()
    return t.spark.range(1).select(
        t["customer"].select(F.count(F.lit(1))).scalar().alias("customers"),
        orders.select(F.count(F.lit(1))).scalar().alias("orders"),
        orders.select(F.max("o_orderkey")).scalar().alias("newest_order"),
        orders.select(F.count_if(F.col("o_orderpriority") == "1-URGENT")).scalar().alias("urgent"),
        states.select(F.expr("listagg(s, ', ') within group (order by s)")).scalar().alias("states"))


@query("""
(select 'first' as part, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice from lineitem
 order by l_extendedprice desc, l_orderkey, l_partkey, l_suppkey, l_linenumber limit 6)
union all
(select 'last', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice from lineitem
 order by l_extendedprice, l_orderkey, l_partkey, l_suppkey, l_linenumber limit 6)""")
def top_entries(t):
    """The first and the last six entries; each task keeps six rows."""
    rows = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    rest = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    ends = {"first": rows.orderBy(F.desc("l_extendedprice"), *rest).limit(6),
            "last": rows.orderBy("l_extendedprice", *rest).limit(6)}
    return sides.tagged_union(ends, tag="part")


@query(f"""
select l_partkey as id, l_suppkey as supplier from lineitem where l_returnflag = 'A'
intersect select l_partkey, l_suppkey from lineitem where l_returnflag = 'R'""")
def common_tables(t):
    lines = t["lineitem"].select(F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("supplier"), "l_returnflag")
    return sides.common_names(lines.filter("l_returnflag = 'A'").drop("l_returnflag"),
                              lines.filter("l_returnflag = 'R'").drop("l_returnflag"))


@query("""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderpriority not in ('1-URGENT', '2-HIGH')
union all
select o_orderkey, o_custkey, 'X', o_totalprice * 2 from orders where o_orderpriority = '1-URGENT'
union all
select o_orderkey + 1000000000000, o_custkey, o_orderstatus, o_totalprice from orders where o_orderpriority = '5-LOW'""")
def branch_overlay(t):
    """The parent's rows with a branch's edits, deletions and additions on top."""
    parent = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    at = F.col("o_orderpriority")
    edits = (parent.filter(at == "1-URGENT").withColumn("o_orderstatus", F.lit("X"))
             .withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumn("deleted", F.lit(False)))
    gone = parent.filter(at == "2-HIGH").withColumn("deleted", F.lit(True))
    added = (parent.filter(at == "5-LOW").withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000_000)
             .withColumn("deleted", F.lit(False)))
    overlay = edits.unionByName(gone).unionByName(added)
    return sides.branch_view(parent, overlay, ["o_orderkey"]).drop("o_orderpriority")
