"""SQL texts shared by the reference queries: canonical rows, digests and the derived sides."""

from __future__ import annotations

# Columns of the given tables: i whole number, d double, s string, t timestamp, a array of floats.
COLUMNS = {
    "region": "r_regionkey:i r_name:s",
    "nation": "n_nationkey:i n_name:s n_regionkey:i",
    "customer": "c_custkey:i c_name:s c_nationkey:i c_acctbal:d c_mktsegment:s",
    "supplier": "s_suppkey:i s_name:s s_nationkey:i s_acctbal:d",
    "part": "p_partkey:i p_name:s p_brand:s p_type:s p_size:i p_retailprice:d",
    "orders": "o_orderkey:i o_custkey:i o_orderstatus:s o_totalprice:d o_orderdate:t o_orderpriority:s",
    "lineitem": "l_orderkey:i l_partkey:i l_suppkey:i l_linenumber:i l_quantity:d l_extendedprice:d l_discount:d l_tax:d "
                "l_returnflag:s l_linestatus:s l_shipdate:t",
    "events": "event_id:i ts:t user_id:i event_type:s value:d props:s",
    "documents": "doc_id:i text:s lang:s source:s n_chars:i",
    "embeddings": "vec_id:i embedding:a label:i",
    "pages": "page_id:i url:s html:s",
    "benchmark": "item_id:i text:s",
    "labels": "doc_id:i quality:i toxic:i",
    "conversations": "conv_id:i turn:i role:s text:s",
}

DRIFTED_ORDERS = """(
  select o_orderkey, case when o_orderkey % 101 = 0 then o_custkey + 1 else o_custkey end as o_custkey,
         o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders where o_orderkey % 97 <> 0
  union all
  select o_orderkey + 1000000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  from orders where o_orderkey % 89 = 0)"""
DRIFTED_CUSTOMER = """(
  select c_custkey, c_name, c_nationkey, case when c_custkey % 50 <> 0 then c_acctbal end as c_acctbal, c_mktsegment
  from customer)"""
DRIFTED_LINEITEM = """(
  select * from lineitem where l_orderkey % 113 <> 0 union all select * from lineitem where l_orderkey % 127 = 0)"""

LISTING = """(
  select p_brand as database, p_type as schema, replace(p_name, ' ', '_') || '_' || p_partkey as "table",
         case when p_size % 5 = 0 then 'VIEW' else 'BASE TABLE' end as kind,
         case when p_size > 40 then 'platform_admin' else 'app_owner' end as owner, cast(p_size as bigint) as size
  from part)"""


def _text(name: str, kind: str) -> str:
    if kind == "d":
        return (f"case when abs({name}) < 1e12 then cast(cast(floor({name} * 1e6 + 0.5) as bigint) as varchar) "
                f"else 'd' || cast({name} as varchar) end")
    if kind == "t":
        return f"cast(epoch_us({name}) as varchar)"
    if kind == "s":
        return rf"replace(replace({name}, '\', '\\'), '|', '\|')"
    if kind == "a":
        inner = _cell("cast(x as double)", "d")
        return f"'[' || array_to_string(list_transform({name}, lambda x: {inner}), ',') || ']'"
    return f"cast({name} as varchar)"


def _cell(name: str, kind: str) -> str:
    return rf"coalesce({_text(name, kind)}, '\N')"


def row_md5(table: str, columns: list[str] | None = None) -> str:
    pairs = [c.split(":") for c in COLUMNS[table].split()]
    return "md5(concat_ws('|', " + ", ".join(_cell(n, k) for n, k in pairs if columns is None or n in columns) + "))"


def bag_digest(md5_sql: str) -> str:
    parts = [f"coalesce(cast(sum(cast(concat('0x', substr({md5_sql}, {at}, 15)) as bigint)) as varchar), '0')" for at in (1, 16)]
    return f"concat_ws(':', {parts[0]}, {parts[1]})"


def fingerprint(table: str, source: str | None = None, label: str = "") -> str:
    return f"select {label} count(*) as \"rows\", {bag_digest(row_md5(table))} as digest from {source or table}"
