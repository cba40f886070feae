"""Around a switch: kept writes, stranded rows, access rules, rebuilt branches, replication."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableshift.operators import switchover
from tableshift.plans import rebuild
from tableshift.queries.registry import query
from tableshift.sources.sides import Side

_PAUSED, _RESUMED = 883_612_800_000_000, 888_710_400_000_000  # 1998-01-01 and 1998-03-01
_OLD = f"made <= {_PAUSED} and o_orderkey % 193 <> 0 or o_orderkey % 211 = 0"
_NEW = (f"made <= {_PAUSED} and o_orderkey % 97 <> 0 or made > {_PAUSED} and made < {_RESUMED} and o_orderkey % 7 = 0 "
        f"or made >= {_RESUMED} and o_orderkey % 101 <> 0")
_SIDES = f"""
with o as (select o_orderkey, epoch_us(o_orderdate) as made from orders),
m as (select 's' as side, o_orderkey, made from o where o_orderkey % 53 <> 0 union all select 'o', o_orderkey, null from o where {_OLD}
    union all select 'n', o_orderkey, null from o where {_NEW} union all select 'n', o_orderkey, null from o where ({_NEW}) and o_orderkey % 103 = 0),
c as (select o_orderkey, count(*) filter (where side = 's') as sent, max(made) as sent_at, count(*) filter (where side = 'o') as on_old,
    count(*) filter (where side = 'n') as on_new from m group by 1),
w as (select o_orderkey, sent_at, on_old, on_new, case when sent = 0 then 'unsent' when on_old = 0 and on_new = 0 then 'lost'
    when on_new > sent then 'repeated' when sent_at is null then 'undated'
    when sent_at <= {_PAUSED} then case when on_new > 0 then 'carried' else 'left behind' end
    when sent_at < {_RESUMED} then 'within the pause' when on_new > 0 then 'served' else 'stranded' end as outcome from c)
"""


def _outcomes(t):
    """Orders as acknowledged writes around a pause; some never reach a side, some reach the wrong one, twice, or unasked."""
    log = t["orders"].select("o_orderkey", t.micros("orders", "o_orderdate").alias("made"))
    new = log.filter(_NEW)
    return switchover.write_continuity(log.filter("o_orderkey % 53 <> 0"), log.filter(_OLD), new.unionByName(new.filter("o_orderkey % 103 = 0")),
                                       ["o_orderkey"], "made", _PAUSED, _RESUMED)


@query(_SIDES + "select * from w")
def write_continuity(t):
    """What became of every order around a switch."""
    return _outcomes(t)


@query(_SIDES + """select outcome, count(*) as writes, min(sent_at) as first_at, max(sent_at) as last_at, outcome in ('carried', 'served') as kept
from w group by 1""")
def continuity_summary(t):
    return switchover.continuity_summary(_outcomes(t))


@query("""
with new as (select * from orders where o_orderkey % 97 <> 0), late as (select * from orders where o_orderkey % 211 = 0 or o_orderkey % 1067 = 0),
ids as (select o_orderkey as old_id, row_number() over (order by o_orderkey) + (select max(o_orderkey) from new) as new_id,
    o_orderkey in (select o_orderkey from new) as collides from late),
lines as (select l_orderkey, count(*) as lines, cast(sum(l_linenumber) as bigint) as numbers from lineitem group by 1)
select new_id as o_orderkey, old_id, collides, o_custkey, o_orderstatus, coalesce(lines, 0) as lines, coalesce(numbers, 0) as numbers
from late join ids on old_id = o_orderkey left join lines on l_orderkey = old_id""")
def stranded_rescue(t):
    """Late orders of the old side under fresh ids, each with its lines, which refer to the new id."""
    orders, lines = t["orders"], t["lineitem"]
    late = orders.filter("o_orderkey % 211 = 0 or o_orderkey % 1067 = 0")
    late_lines = lines.join(late.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    rows, children, ids = switchover.rescue(late, orders.filter("o_orderkey % 97 <> 0"), "o_orderkey", {"lineitem": (late_lines, "l_orderkey")})
    counted = children["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_linenumber").alias("numbers"))
    return (rows.join(ids.withColumnRenamed("new_id", "o_orderkey"), "o_orderkey").join(counted, "o_orderkey", "left")
            .select("o_orderkey", "old_id", "collides", "o_custkey", "o_orderstatus", F.coalesce("lines", F.lit(0)).alias("lines"),
                    F.coalesce("numbers", F.lit(0)).alias("numbers")))


_SYSTEM = ("^cloud_admin$", "^platform_")
_PRIVILEGE = "case o_orderstatus when 'O' then 'SELECT' when 'F' then 'INSERT' else 'UPDATE' end"
_OWNER = "case when c_custkey % 29 = 0 then 'platform_sync' else concat('owner_', cast(c_custkey % 13 as {})) end"


def _access(t):
    """Every customer is a table of its nation's database, in the schema of its segment, owned by one of thirteen roles."""
    place = ["cast(c_nationkey as string) as database", "c_mktsegment as schema", "c_name as table"]
    people = t["customer"]
    grants = t["orders"].join(people, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        *place, "concat('reader \"', c_nationkey, '\"') as grantee", f"{_PRIVILEGE} as privilege", "o_orderkey")
    owner = _OWNER.format("string")
    reader = "concat('reader \"', {}, '\"')"
    defaults = t["supplier"].selectExpr("cast(s_nationkey as string) as database", "'BUILDING' as schema",
                                        "concat('owner_', s_suppkey % 13) as owner", "if(s_suppkey % 10 = 0, 'PUBLIC', 'reader') as grantee",
                                        "'SELECT' as privilege", "s_suppkey")
    old = {"roles": people.selectExpr(f"{owner} as role").union(t["nation"].selectExpr(reader.format("n_nationkey"))),
           "members": people.selectExpr(f"{reader.format('c_nationkey')} as role", f"{owner} as member"),
           "owners": people.selectExpr(*place, f"{owner} as owner"), "grants": grants, "defaults": defaults}
    moved = people.filter("c_custkey % 17 <> 0")
    new = {"roles": old["roles"].filter("role like '%1%'"), "members": people.filter("c_custkey % 4 = 0").selectExpr(
               f"{reader.format('c_nationkey')} as role", f"{owner} as member"),
           "owners": moved.selectExpr(*place, f"if(c_custkey % 5 = 0, 'cloud_admin', {owner}) as owner"),
           "grants": grants.filter("o_orderkey % 3 <> 0"), "defaults": defaults.filter("s_suppkey % 2 = 0")}
    return old, new


_OWNER_SQL = _OWNER.format("varchar")


def _name(column: str) -> str:
    return f"""case when {column} = 'PUBLIC' then {column} else '"' || replace({column}, '"', '""') || '"' end"""


@query(f"""
with c as (select c_custkey, cast(c_nationkey as varchar) as d, c_mktsegment as s, c_name as t, {_OWNER_SQL} as owner,
    'reader "' || c_nationkey || '"' as reader from customer),
roles as (select owner as role from c union select 'reader "' || n_nationkey || '"' from nation),
members as (select distinct reader, owner from c),
owners as (select * from c where c_custkey % 17 <> 0 and c_custkey % 5 = 0 and not regexp_matches(owner, '^platform_')),
g as (select d, s, t, reader, {_PRIVILEGE} as p, o_orderkey, c_custkey from orders join c on c_custkey = o_custkey),
f as (select cast(s_nationkey as varchar) as d, 'BUILDING' as s, 'owner_' || s_suppkey % 13 as owner,
    case when s_suppkey % 10 = 0 then 'PUBLIC' else 'reader' end as grantee, s_suppkey from supplier)
select 1 as step, null::varchar as database, 'CREATE ROLE ' || {_name('role')} as statement from roles where role not like '%1%' and not regexp_matches(role, '^platform_')
union all select 2, null, 'GRANT ' || {_name('reader')} || ' TO ' || {_name('owner')} from (
    select reader, owner from members except select reader, owner from c where c_custkey % 4 = 0) where not regexp_matches(owner, '^platform_')
union all select distinct 3, d, 'GRANT CREATE ON SCHEMA ' || {_name('s')} || ' TO ' || {_name('owner')} from owners
union all select 4, d, 'ALTER TABLE ' || {_name('s')} || '.' || {_name('t')} || ' OWNER TO ' || {_name('owner')} from owners
union all select distinct 5, d, 'REVOKE CREATE ON SCHEMA ' || {_name('s')} || ' FROM ' || {_name('owner')} from owners
union all select 6, d, 'GRANT ' || p || ' ON ' || {_name('s')} || '.' || {_name('t')} || ' TO ' || {_name('reader')} from (
    select d, s, t, reader, p from g where c_custkey % 17 <> 0 except select d, s, t, reader, p from g where o_orderkey % 3 <> 0)
union all select 7, d, 'ALTER DEFAULT PRIVILEGES FOR ROLE ' || {_name('owner')} || ' IN SCHEMA ' || {_name('s')} || ' GRANT SELECT ON TABLES TO ' || {_name('grantee')}
    from (select d, s, owner, grantee from f except select d, s, owner, grantee from f where s_suppkey % 2 = 0)""")
def access_rebuild(t):
    """The statements that give the new side the old side's roles, owners, grants and defaults."""
    return switchover.access_rebuild(*_access(t), system=_SYSTEM)


_BRANCH_ORDERS = """(select o_orderkey, o_custkey, case when o_orderkey % 11 = 0 then 'B' else o_orderstatus end as o_orderstatus,
    o_totalprice, o_orderdate, o_orderpriority from orders where o_orderkey % 41 <> 0)"""
_NOW_ORDERS = """(select o_orderkey, case when o_orderkey % 13 = 0 then o_custkey + 1 else o_custkey end as o_custkey,
    case when o_orderkey % 55 = 0 then 'N' else o_orderstatus end as o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    from orders where o_orderkey % 43 <> 0)"""


def _sides(t):
    """Production when a branch was made, the branch after edits of its own, and production now."""
    orders, key = t["orders"], F.col("o_orderkey")
    base = Side.of("base", {"sales": {"orders": orders, "customer": t["customer"], "supplier": t["supplier"], "nation": t["nation"]}})
    own = orders.filter(key % 41 != 0).withColumn("o_orderstatus", F.when(key % 11 == 0, "B").otherwise(F.col("o_orderstatus")))
    branch = Side.of("branch", {"sales": {"orders": own, "customer": t["customer"], "nation": t["nation"], "part": t["part"]}})
    now = (orders.filter(key % 43 != 0).withColumn("o_custkey", F.when(key % 13 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
           .withColumn("o_orderstatus", F.when(key % 55 == 0, "N").otherwise(F.col("o_orderstatus"))))
    production = Side.of("now", {"sales": {"orders": now, "customer": t["customer"], "supplier": t["supplier"], "nation": t["nation"],
                                           "region": t["region"]}})
    return base, branch, production


_SALES_KEYS = {("sales", "orders"): ["o_orderkey"], ("sales", "customer"): ["c_custkey"]}
_ZERO = ", ".join(f"0::bigint as {e}" for e in ("take", "merge", "delete", "conflict"))


@query(f"""
with m as (select o_orderkey as k, b.o_orderstatus as bs, b.o_custkey as bc, r.o_orderkey as rk, r.o_orderstatus as rs, n.o_orderkey as nk,
    n.o_orderstatus as ns, n.o_custkey as nc from orders b left join {_BRANCH_ORDERS} r using (o_orderkey) left join {_NOW_ORDERS} n using (o_orderkey)),
a as (select case
    when rk is null and nk is null then 'gone'
    when rk is null then case when ns <> bs or nc <> bc then 'conflict' else 'delete' end
    when nk is null then case when rs <> bs then 'conflict' else 'gone' end
    when rs <> bs and ns <> bs and rs <> ns then 'conflict'
    when rs = ns and nc = bc then 'same'
    when rs <> bs and ns = bs and nc = bc then 'take'
    when rs <> bs then 'merge' else 'keep' end as action from m)
select 'sales' as database, 'orders' as "table", case when count(*) filter (where action = 'conflict') > 0 then 'resolve'
    when count(*) filter (where action in ('take', 'merge', 'delete')) > 0 then 'apply edits' else 'keep' end as action,
    count(*) filter (where action <> 'gone') as "rows", count(*) filter (where action = 'take') as take, count(*) filter (where action = 'merge') as merge,
    count(*) filter (where action = 'delete') as "delete", count(*) filter (where action = 'conflict') as conflict from a
union all select 'sales', 'customer', 'keep', count(*), {_ZERO} from customer
union all select 'sales', 'supplier', 'dropped on the branch', count(*), {_ZERO} from supplier
union all select 'sales', 'nation', 'no key', count(*), {_ZERO} from nation
union all select 'sales', 'part', 'load', count(*), {_ZERO} from part
union all select 'sales', 'region', 'new in production', count(*), {_ZERO} from region""")
def rebuild_plan(t):
    """What to load, apply and resolve when a branch is rebuilt from newer production."""
    return rebuild.rebuild_plan(*_sides(t), _SALES_KEYS)


@query(f"""
select o_orderkey, coalesce(n.o_custkey, b.o_custkey) as o_custkey, case when r.o_orderstatus <> b.o_orderstatus and n.o_orderstatus = b.o_orderstatus
    then r.o_orderstatus else n.o_orderstatus end as o_orderstatus, n.o_totalprice
from {_NOW_ORDERS} n join orders b using (o_orderkey) left join {_BRANCH_ORDERS} r using (o_orderkey)
where r.o_orderkey is not null or n.o_orderstatus <> b.o_orderstatus or n.o_custkey <> b.o_custkey""")
def rebuilt_branch(t):
    """The orders of the rebuilt branch, with production's values where both sides changed the same."""
    side = rebuild.rebuilt(*_sides(t), _SALES_KEYS, keep_conflicts=True)
    return side.table("sales", "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("""
select 'sales' as database, 'customer' as "table", (select count(*) from customer) as "rows", 0::bigint as surplus, 0::bigint as empty_keys,
    0::bigint as target_rows, 'none' as problem
union all select 'sales', 'events', count(*), null, null, 0, 'no key' from events
union all select 'sales', 'lineitem', count(*), count(*) - count(distinct (l_orderkey, l_linenumber)), 0, 0, 'key repeats' from lineitem
union all select 'sales', 'nation', count(*), 0, 0, null, 'no target table' from nation
union all select 'sales', 'orders', count(*), 0, 0, 0, 'columns differ' from orders
union all select 'sales', 'part', count(*), 0, count(*) filter (where p_size = 7), 0, 'key is empty' from part
union all select 'sales', 'supplier', count(*), 0, 0, count(*), 'target is not empty' from supplier""")
def replication_readiness(t):
    """Which tables row replication could keep current, and what stands in the way of the others."""
    part = t["part"].withColumn("p_partkey", F.when(F.col("p_size") != 7, F.col("p_partkey")))
    sales = {n: t[n] for n in ("customer", "events", "lineitem", "nation", "orders", "supplier")} | {"part": part}
    there = {n: df.limit(0) for n, df in sales.items() if n != "nation"} | {"supplier": t["supplier"]}
    there["orders"] = there["orders"].withColumn("o_totalprice", F.col("o_totalprice").cast("float"))
    keys = {"customer": ["c_custkey"], "lineitem": ["l_orderkey", "l_linenumber"], "nation": ["n_nationkey"], "orders": ["o_orderkey"],
            "part": ["p_partkey"], "supplier": ["s_suppkey"]}
    return rebuild.replication_readiness(Side.of("old", {"sales": sales}), Side.of("new", {"sales": there}),
                                         {("sales", n): k for n, k in keys.items()})
