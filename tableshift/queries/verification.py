"""Copy verification: fingerprints, watermarks, sequences, schemas, row diffs, constraints."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableshift.operators import compare, diff, digest
from tableshift.operators.constraints import ForeignKey, Rules, constraint_report as report
from tableshift.plans.verify import drill_down
from tableshift.queries import sqltext as q
from tableshift.queries.registry import query
from tableshift.sources import fixtures as fx
from tableshift.sources.schema_text import schema_lines
from tableshift.sources.sides import union_all

_SIDES = {("sales", "customer"): q.DRIFTED_CUSTOMER, ("sales", "lineitem"): q.DRIFTED_LINEITEM,
          ("sales", "nation"): "nation", ("sales", "orders"): q.DRIFTED_ORDERS, ("stock", "part"): "part"}


def _prints(sides: dict) -> str:
    return " union all ".join(q.fingerprint(t, src, f"'{db}' as database, '{t}' as \"table\",")
                              for (db, t), src in sides.items())


_OLD = {**{k: k[1] for k in _SIDES}, ("stock", "supplier"): "supplier"}


@query(f"""
with old as ({_prints(_OLD)}), new as ({_prints(_SIDES)})
select coalesce(old.database, new.database) as database, coalesce(old."table", new."table") as "table",
       old."rows" as rows_old, new."rows" as rows_new,
       old."rows" is not distinct from new."rows" and old.digest is not distinct from new.digest as identical
from old full join new on old.database = new.database and old."table" = new."table" """)
def copy_compare(t):
    return compare.copy_compare(fx.old_side(t), fx.new_side(t), exact=False)


@query(" union all ".join(q.fingerprint(n, n, f"'given' as database, '{n}' as \"table\",") for n in fx.TABLES))
def digest_bag(t):
    return digest.fingerprint({("given", n): t[n] for n in fx.TABLES}, exact=False)


def _tree(table: str) -> str:
    level = (f"select substr(h, 1, {digest.TREE_DEPTH}) as node, sum(n) as n, md5(string_agg(h || ':' || n, '|' order by h)) as digest "
             f"from (select {q.row_md5(table)} as h, count(*) as n from {table} group by 1) group by 1")
    for depth in range(digest.TREE_DEPTH - 2, 0, -2):
        level = (f"select substr(node, 1, {depth}) as node, sum(n) as n, md5(string_agg(node || ':' || digest, '|' order by node)) as digest "
                 f"from ({level}) group by 1")
    return f"""
select '{table}' as "table", coalesce(cast(sum(n) as bigint), 0) as "rows",
       coalesce(md5(string_agg(node || ':' || digest, '|' order by node)), md5('')) as digest from ({level})"""


_TREES = ("documents", "events", "lineitem", "orders")


@query(" union all ".join(_tree(n) for n in _TREES))
def digest_exact(t):
    return union_all(digest.tree_digest(t[n], exact=False).select(F.lit(n).alias("table"), "rows", "digest") for n in _TREES)


_BUCKETS = "select substr({key}, 1, 2) as bucket, count(*) as \"rows\", {digest} as digest from {src} group by 1"


def _buckets(src: str) -> str:
    return _BUCKETS.format(key=q.row_md5("orders", ["o_orderkey"]), digest=q.bag_digest(q.row_md5("orders")), src=src)


@query(f"""
with old as ({_buckets('orders')}), new as ({_buckets(q.DRIFTED_ORDERS)})
select coalesce(old.bucket, new.bucket) as bucket, old."rows" as rows_old, new."rows" as rows_new,
       old."rows" is not distinct from new."rows" and old.digest is not distinct from new.digest as identical
from old full join new on old.bucket = new.bucket""")
def digest_buckets(t):
    return compare.bucket_compare(t["orders"], fx.drifted_orders(t), ["o_orderkey"], exact=False)


@query(f"""
select 'customer' as "table", a.m as newest_old, a.n as rows_old, b.m as newest_new, b.n as rows_new,
       a.m = b.m and a.n = b.n as matches
from (select max(c_custkey) as m, count(*) as n from customer) a,
     (select max(c_custkey) as m, count(*) as n from {q.DRIFTED_CUSTOMER}) b
union all
select 'orders', a.m, a.n, b.m, b.n, a.m = b.m and a.n = b.n
from (select max(o_orderkey) as m, count(*) as n from orders) a,
     (select max(o_orderkey) as m, count(*) as n from {q.DRIFTED_ORDERS}) b""")
def watermark(t):
    return compare.watermark_compare(
        {"customer": (t["customer"], "c_custkey"), "orders": (t["orders"], "o_orderkey")},
        {"customer": (fx.drifted_customer(t), "c_custkey"), "orders": (fx.drifted_orders(t), "o_orderkey")})


@query(f"""
with old as (select 'status_' || o_orderstatus || '_seq' as sequence, max(o_orderkey) as v from orders group by 1),
ids as (select 'status_' || o_orderstatus || '_seq' as sequence, max(o_orderkey) as newest_id from {q.DRIFTED_ORDERS}
        group by 1),
seqs as (select 'status_' || o_orderstatus || '_seq' as sequence, max(o_orderkey) as v from orders
         where o_orderpriority <> '1-URGENT' group by 1)
select old.sequence, old.v as last_value_old, seqs.v as last_value_new, ids.newest_id,
       coalesce(seqs.v >= old.v, false) as ok, coalesce(ids.newest_id <= seqs.v, false) as covers_ids,
       ids.newest_id + 1 as reset_to
from old join seqs using (sequence) join ids using (sequence)""")
def sequence_check(t):
    name = F.concat(F.lit("status_"), "o_orderstatus", F.lit("_seq")).alias("sequence")
    old = t["orders"].groupBy(name).agg(F.max("o_orderkey").alias("last_value"))
    copied = (t["orders"].filter("o_orderpriority <> '1-URGENT'").groupBy(name)
              .agg(F.max("o_orderkey").alias("last_value")))
    ids = fx.drifted_orders(t).groupBy(name).agg(F.max("o_orderkey").alias("newest_id"))
    return compare.sequence_compare(old, copied.join(ids, "sequence"), mode="at_or_past")


_PAIRS = [p.split(":")[0] for p in q.COLUMNS["orders"].split()][1:]


def _changed(prefix: str = "") -> str:
    whens = ", ".join(f"case when a.o_orderkey is not null and b.o_orderkey is not null "
                      f"and a.{c} is distinct from b.{c} then '{c}' end" for c in _PAIRS)
    return f"concat_ws(',', {whens})"


_ROW_DIFF = f"""
select * from (
  select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey,
         case when a.o_orderkey is null then 'added' when b.o_orderkey is null then 'removed'
              when {_changed()} <> '' then 'changed' else 'same' end as change,
         {_changed()} as changed_columns
  from orders a full join {q.DRIFTED_ORDERS} b on a.o_orderkey = b.o_orderkey)
where change <> 'same'"""


@query(_ROW_DIFF)
def row_diff(t):
    """Fingerprints find the table, bucket digests the rows to shuffle, then rows are compared."""
    found = drill_down(fx.Side.of("old", {"sales": {"orders": t["orders"]}}),
                       fx.Side.of("new", {"sales": {"orders": fx.drifted_orders(t)}}), {("sales", "orders"): ["o_orderkey"]})
    return found[("sales", "orders")]


@query(f"""
select 'customer' as "table", 'c_acctbal' as changed_column, count(*) as "rows"
from customer a join {q.DRIFTED_CUSTOMER} b using (c_custkey) where a.c_acctbal is distinct from b.c_acctbal
union all
select 'orders', unnest(string_split(changed_columns, ',')) as c, count(*) from ({_ROW_DIFF}) where change = 'changed'
group by 2""")
def changed_columns(t):
    parts = {"customer": diff.row_diff(t["customer"], fx.drifted_customer(t), ["c_custkey"]),
             "orders": diff.row_diff(t["orders"], fx.drifted_orders(t), ["o_orderkey"])}
    return union_all(diff.changed_column_counts(d).select(F.lit(n).alias("table"), "changed_column", "rows")
                     for n, d in parts.items())


@query(f"""
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, epoch_us(l_shipdate) as shipped, cast(sum(d) as bigint) as delta
from (select *, -1 as d from lineitem union all select *, 1 from {q.DRIFTED_LINEITEM})
group by all having sum(d) <> 0""")
def bag_diff(t):
    found = diff.bag_diff(t["lineitem"], fx.drifted_lineitem(t))
    return found.withColumn("shipped", t.micros("lineitem", "l_shipdate")).drop("l_shipdate")


@query(f"select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey not in (select o_orderkey from {q.DRIFTED_ORDERS})")
def lost_rows(t):
    return diff.missing_rows(t["orders"], fx.drifted_orders(t), ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


_TYPES = {"customer": "bigint string int double string", "part": "bigint string string string int double",
          "supplier": "bigint string int double"}


def _schema(side: str) -> str:
    parts = []
    for table, types in _TYPES.items():
        names = [p.split(":")[0] for p in q.COLUMNS[table].split()]
        for i, (c, ty) in enumerate(zip(names, types.split())):
            src = table
            if side == "new":
                if table == "supplier":
                    continue
                if c == "p_type":
                    c, src = "p_kind", "(select p_type as p_kind from part)"
                if c == "p_size":
                    ty = "bigint"
                if c == "c_acctbal":
                    src = q.DRIFTED_CUSTOMER
            parts.append(f"select '{table}' as \"table\", '{c}' as \"column\", {i} as position, '{ty}' as type, "
                         f"count(*) - count({c}) as nulls from {src}")
    return " union all ".join(parts)


@query(f"""
with old as ({_schema('old')}), new as ({_schema('new')})
select coalesce(old."table", new."table") as "table", coalesce(old."column", new."column") as "column",
       old.position as position_old, old.type as type_old, old.nulls as nulls_old,
       new.position as position_new, new.type as type_new, new.nulls as nulls_new,
       case when new.position is null then 'missing' when old.position is null then 'added'
            when old.type <> new.type then 'retyped' when old.position <> new.position then 'moved'
            when (old.nulls = 0) <> (new.nulls = 0) then 'nullability' else 'same' end as status
from old full join new on old."table" = new."table" and old."column" = new."column" """)
def schema_diff(t):
    changed_part = t["part"].withColumnRenamed("p_type", "p_kind").withColumn("p_size", F.col("p_size").cast("bigint"))
    old = {n: t[n] for n in _TYPES}
    new = {"customer": fx.drifted_customer(t), "part": changed_part}
    return compare.schema_diff(compare.schema_rows(old), compare.schema_rows(new))


def _lines(text: str) -> str:
    return f"""
select doc_id as file, unnest(ls) as line, unnest(generate_series(0, len(ls) - 1)) as position
from (select doc_id, list_filter(regexp_split_to_array({text}, '\\r\\n|\\n|\\r'), lambda l: trim(l, ' ') <> ''
      and not starts_with(l, '--') and not starts_with(l, '\\restrict') and not starts_with(l, '\\unrestrict')
      and not starts_with(l, 'SET ') and not starts_with(l, 'SELECT pg_catalog.')) as ls from documents) where len(ls) > 0"""


_NEW_TEXT = "case when lang = 'en' then '-- copied' || chr(10) || text || chr(10) || 'END;' else replace(text, 'The ', 'A ') end"


@query(f"""
with old as ({_lines('text')}), new as ({_lines(_NEW_TEXT)})
select coalesce(old.file, new.file) as file, count(old.line) as lines_old, count(new.line) as lines_new,
       count(*) filter (where old.line is distinct from new.line) as differing,
       min(case when old.line is distinct from new.line then coalesce(old.position, new.position) end) as first_difference,
       count(*) filter (where old.line is distinct from new.line) = 0 as identical
from old full join new on old.file = new.file and old.position = new.position group by 1""")
def schema_text_diff(t):
    """Every document is taken as a schema file; English ones get a comment, which is ignored, and one more line."""
    docs = t["documents"]
    text = (F.when(F.col("lang") == "en", F.concat(F.lit("-- copied\n"), "text", F.lit("\nEND;")))
            .otherwise(F.replace("text", F.lit("The "), F.lit("A "))))
    new = docs.withColumn("text", text)
    return compare.text_diff(schema_lines(docs, "doc_id"), schema_lines(new, "doc_id"))


def _null_rule(table, src, columns):
    return [f"select '{table}' as \"table\", 'not_null' as kind, '{c}' as rule, count(*) - count({c}) as violations from {src}"
            for c in columns]


def _dup_rule(table, src, kind, columns):
    keys = ", ".join(columns)
    filled = " and ".join(f"{c} is not null" for c in columns)
    return (f"select '{table}', '{kind}', '{','.join(columns)}', coalesce(cast(sum(n - 1) as bigint), 0) from "
            f"(select count(*) as n from {src} where {filled} group by {keys} having count(*) > 1)")


_BROKEN = """(
  select o_orderkey, case when o_orderkey % 1009 = 0 then o_custkey + 1000000000000 else o_custkey end as o_custkey,
         o_totalprice from orders
  union all select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey % 503 = 0)"""


@query(" union all ".join([
    *_null_rule("customer", q.DRIFTED_CUSTOMER, ["c_name", "c_acctbal", "c_custkey"]),
    _dup_rule("customer", q.DRIFTED_CUSTOMER, "primary_key", ["c_custkey"]),
    _dup_rule("customer", q.DRIFTED_CUSTOMER, "unique", ["c_acctbal"]),
    *_null_rule("lineitem", "lineitem", ["l_orderkey", "l_linenumber"]),
    _dup_rule("lineitem", "lineitem", "primary_key", ["l_orderkey", "l_linenumber"]),
    *_null_rule("orders", _BROKEN, ["o_orderkey"]),
    f"select 'orders', 'check', 'price in range', count(*) filter (where o_totalprice not between 1000 and 450000) from {_BROKEN}",
    _dup_rule("orders", _BROKEN, "primary_key", ["o_orderkey"]),
    f"select 'orders', 'foreign_key', 'o_custkey->customer', count(*) from {_BROKEN} "
    "where o_custkey is not null and o_custkey not in (select c_custkey from customer)",
    "select 'part', 'check', 'percent', count(*) filter (where p_size * 2 not between 1 and 90) from part",
]))
def constraint_report(t):
    o, key = t["orders"], F.col("o_orderkey")
    moved = o.withColumn("o_custkey", F.when(key % 1009 == 0, F.col("o_custkey") + 1_000_000_000_000)
                         .otherwise(F.col("o_custkey")))
    tables = {"customer": fx.drifted_customer(t), "lineitem": t["lineitem"], "part": t["part"],
              "orders": moved.unionByName(o.filter(key % 503 == 0))}
    return report(tables, {
        "customer": Rules(not_null=["c_name", "c_acctbal"], primary_key=["c_custkey"], unique=[["c_acctbal"]]),
        "lineitem": Rules(primary_key=["l_orderkey", "l_linenumber"]),
        "orders": Rules(primary_key=["o_orderkey"], checks={"price in range": "o_totalprice between 1000 and 450000"},
                        foreign_keys=[ForeignKey(["o_custkey"], "customer", ["c_custkey"])]),
        "part": Rules(checks={"percent": "p_size * 2 between 1 and 90"}),
    })


@query("select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1")
def duplicate_keys(t):
    return diff.duplicate_keys(t["lineitem"], ["l_orderkey", "l_linenumber"])
