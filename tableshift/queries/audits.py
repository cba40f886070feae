"""Audits: ownership, access, leftovers, hierarchy, compatibility, names, addresses, error texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableshift.functions.text import resource_path
from tableshift.operators import audit, graph
from tableshift.queries.registry import query
from tableshift.sources import fixtures as fx


def _app_tables(t):
    """Every customer is an app table in the database of its nation, owned by its segment, created in key order."""
    return t["customer"].select(F.col("c_nationkey").alias("database"), F.col("c_name").alias("table"),
                                F.col("c_mktsegment").alias("owner"), F.col("c_custkey").alias("created"))


@query("""
select n_name as database, c_name as "table", r_name as owner
from customer join nation on n_nationkey = c_nationkey left join region on r_regionkey = c_custkey % 6""")
def ownership_report(t):
    """Tables of every database with their owners; the owner of some is not a known role."""
    tables = t["customer"].join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("database"), F.col("c_name").alias("table"), (F.col("c_custkey") % 6).alias("owner_id"))
    roles = t["region"].select(F.col("r_regionkey").cast("bigint").alias("owner_id"), F.col("r_name").alias("owner"))
    return audit.ownership(tables, roles)


@query("""
with direct as (select distinct o_custkey from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'F'),
standing as (select s_nationkey as database, case s_suppkey % 3 when 0 then 'BUILDING' when 1 then 'MACHINERY' else 'FURNITURE' end as owner,
                    min(s_suppkey * 10) as since from supplier where s_acctbal > 3000 group by 1, 2)
select c_nationkey as database, c_name as "table", c_mktsegment as owner,
       c_custkey in (select o_custkey from direct) or coalesce(c_custkey > since, false) as can_read
from customer left join standing on standing.database = c_nationkey and standing.owner = c_mktsegment""")
def access_audit(t):
    """Urgent finished orders are direct grants on a table; suppliers are default grants on later tables of an owner."""
    tables = _app_tables(t)
    named = t["orders"].filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("created")).distinct()
    direct = tables.join(named, "created").select("database", "table", F.lit("app_reader").alias("grantee"))
    owner = F.when(F.col("s_suppkey") % 3 == 0, "BUILDING").when(F.col("s_suppkey") % 3 == 1, "MACHINERY").otherwise("FURNITURE")
    default = t["supplier"].select(
        F.col("s_nationkey").alias("database"), owner.alias("owner"), (F.col("s_suppkey") * 10).alias("since"),
        F.when(F.col("s_acctbal") > 3000, "app_reader").otherwise("someone_else").alias("grantee"))
    return audit.access_report(tables, direct, default, "app_reader")


@query("""
with recursive held as (
  select distinct o_custkey as role, o_orderstatus as privilege from orders
  union
  select m.member, held.privilege from (select c_custkey // 2 as role, c_custkey as member from customer where c_custkey > 0) m
  join held on held.role = m.role)
select role, privilege from held""")
def effective_grants(t):
    """Orders are grants to their customer's role; every customer is a member of the role at half its key."""
    grants = t["orders"].select(
        F.col("o_custkey").alias("role"), F.col("o_orderstatus").alias("privilege"))
    key = F.col("c_custkey")
    members = t["customer"].filter(key > 0).select(F.floor(key / 2).alias("role"), key.alias("member"))
    return audit.effective_grants(grants, members)


@query("select distinct o_custkey as role from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)")
def missing_roles(t):
    expected = t["orders"].select(F.col("o_custkey").alias("role"))
    return audit.missing_names(expected, t["customer"].filter("c_acctbal > 0").select(F.col("c_custkey").alias("role")), ["role"])


@query("""
select distinct l_partkey as source, l_suppkey as catalog from lineitem where l_returnflag = 'R'
except select l_partkey, l_suppkey from lineitem where l_linestatus = 'F'""")
def missing_sources(t):
    """Tables that feed a sync on the old side and are absent from the new catalog."""
    rows = t["lineitem"].select(F.col("l_partkey").alias("source"), F.col("l_suppkey").alias("catalog"), "l_returnflag", "l_linestatus")
    return audit.missing_names(rows.filter("l_returnflag = 'R'"), rows.filter("l_linestatus = 'F'"), ["source", "catalog"])


@query("""
select 'move-' || c_custkey as name,
       case when n is null then 'absent' when c_acctbal > 0 then 'ours' else 'not ours' end as state,
       case when n is null then 'none' when c_acctbal > 0 then 'delete' else 'leave' end as action
from customer left join (select o_custkey, count(*) as n from orders where o_orderpriority = '5-LOW' and o_orderstatus = 'P' group by 1)
  on o_custkey = c_custkey""")
def leftovers(t):
    """One expected resource per customer; it exists if the customer has open orders, and is ours if the balance is positive."""
    people = t["customer"]
    expected = people.select(F.concat(F.lit("move-"), F.col("c_custkey").cast("string")).alias("name"), F.lit("mine").alias("label"))
    open_ = t["orders"].filter("o_orderpriority = '5-LOW' and o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    found = people.join(open_, "c_custkey", "left_semi").select(
        F.concat(F.lit("move-"), F.col("c_custkey").cast("string")).alias("name"),
        F.when(F.col("c_acctbal") > 0, "mine").otherwise("other").alias("label"))
    return audit.leftovers(expected, found)


@query("""
with versions as (
  select p_brand as feature, cast(l_quantity as int) as major, l_linenumber as minor, l_linestatus = 'F' as old,
         p_size <= 45 or l_quantity < 20 as seen from lineitem join part on p_partkey = l_partkey),
required as (select feature, max((major, minor)) as v from versions where old group by 1),
available as (select feature, max((major, minor)) as v from versions where not old and seen and feature not like '%3' group by 1)
select r.feature, r.v[1] || '.' || r.v[2] as required, a.v[1] || '.' || a.v[2] as available,
       case when a.v is null then 'missing' when a.v < r.v then 'too old' else 'ok' end as status
from required r left join available a using (feature)""")
def compat_audit(t):
    """Versions of each feature used by finished lines against those offered by open ones."""
    used = t["lineitem"].join(t["part"], F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("feature"),
        F.concat_ws(".", F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber").cast("string")).alias("version"),
        "l_linestatus", ((F.col("p_size") <= 45) | (F.col("l_quantity") < 20)).alias("seen"))
    offered = used.filter((F.col("l_linestatus") != "F") & F.col("seen") & ~F.col("feature").like("%3"))
    return audit.compatibility(used.filter("l_linestatus = 'F'").select("feature", "version"), offered.select("feature", "version"))


_TREE = "(select c_custkey as node, case when c_custkey > 2 then c_custkey // 2 end as parent from customer)"
_CHAIN = f"""
with recursive chain as (
  select node, node as root, cast(0 as bigint) as depth, cast(node as varchar) as path from {_TREE} where parent is null
  union all
  select c.node, chain.root, chain.depth + 1, chain.path || '/' || c.node from {_TREE} c join chain on c.parent = chain.node)"""


def _tree(t):
    key = F.col("c_custkey")
    return t["customer"].select(key.alias("node"), F.when(key > 2, F.floor(key / 2)).alias("parent"))


@query(_CHAIN + " select node, root, depth, path, 'projects/' || root || '/branches/' || node as name from chain")
def lineage(t):
    """Every customer is a branch of the one at half its key; three of them are roots."""
    chains = graph.lineage(_tree(t), "node", "parent")
    return chains.withColumn("name", resource_path(projects=F.col("root").cast("string"), branches=F.col("node").cast("string")))


@query(_CHAIN + """
select node, depth, (select max(depth) from chain) - depth as remove_wave, depth as rebuild_wave from chain""")
def teardown_order(t):
    return graph.teardown_waves(graph.lineage(_tree(t), "node", "parent"))


_SLUG = """coalesce(nullif(rtrim(left(trim(regexp_replace(lower(split_part(address, '@', 1)), '[^a-z0-9]+', '-', 'g'), '-'), 16), '-'), ''), 'user')"""


@query(f"""
select slug, cast(sum(n) as bigint) as people, cast(sum(n - 1) as bigint) as with_id_collisions from (
  select {_SLUG} as slug, id, count(*) as n from (
    select c_name || '@example.com' as address, c_custkey as id from customer
    union all select '__' || s_name || '__@example.com', s_suppkey % 50 from supplier
    union all select '@example.com', p_partkey from part) group by 1, 2)
group by 1 having sum(n) > 1""")
def slug_collisions(t):
    """Names that fall together when cut to 16 characters, and whether an id tells them apart."""
    people = (t["customer"].select(F.concat("c_name", F.lit("@example.com")).alias("address"), F.col("c_custkey").alias("id"))
              .union(t["supplier"].select(F.concat(F.lit("__"), "s_name", F.lit("__@example.com")), F.col("s_suppkey") % 50))
              .union(t["part"].select(F.lit("@example.com"), "p_partkey")))
    return audit.slug_collisions(people, "address", "id")


_AUTHORITY = "regexp_extract(full_url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"


@query(f"""
with urls as (
  select page_id, kind, case kind when 'as is' then url when 'https' then replace(url, 'http://', 'https://')
      when 'bare' then split_part(url, '://', 2) when 'user' then replace(url, '://', '://me:pw@')
      when 'port' then regexp_replace(replace(url, 'http://', 'https://'), '(://[^/?#]*)', '\\1:8443')
      when 'accounts' then 'https://accounts.example.com/' || page_id else 'HTTPS://M.Example.COM:0/' || page_id end as url
  from pages, (values ('as is'), ('https'), ('bare'), ('user'), ('port'), ('accounts'), ('upper')) k(kind)),
parts as (
  select *, lower(regexp_extract(full_url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) as scheme, regexp_extract({_AUTHORITY}, '^(.*)@', 1) as cred,
         regexp_replace({_AUTHORITY}, '^.*@', '') as place
  from (select *, case when contains(url, '://') then url else 'https://' || url end as full_url from urls)),
judged as (
  select page_id, kind, url, lower(regexp_extract(place, '^([^:]*)', 1)) as host,
    case when scheme <> 'https' then 'scheme' when split_part(cred, ':', 1) <> '' then 'user'
      when regexp_extract(cred, '^[^:]*:(.*)$', 1) <> '' then 'password'
      when not regexp_full_match(regexp_extract(place, '^[^:]*:(.*)$', 1), '0*') then 'port'
      when starts_with(lower(place), 'accounts.') then 'blocked host'
      when not (ends_with(lower(regexp_extract(place, '^([^:]*)', 1)), '.example.com') or ends_with(lower(regexp_extract(place, '^([^:]*)', 1)), '.example.org')) then 'foreign host'
      else 'ok' end as problem from parts)
select page_id, kind, url, problem, case when problem = 'ok' then 'https://' || host end as clean_url from judged""")
def url_audit(t):
    """Every page's address as it is and in six other forms."""
    url = F.col("url")
    secure = F.replace(url, F.lit("http://"), F.lit("https://"))
    number = F.col("page_id").cast("string")
    forms = {
        "as is": url, "https": secure, "bare": F.substring_index(url, "://", -1),
        "user": F.replace(url, F.lit("://"), F.lit("://me:pw@")),
        "port": F.regexp_replace(secure, "(://[^/?#]*)", "$1:8443"),
        "accounts": F.concat(F.lit("https://accounts.example.com/"), number),
        "upper": F.concat(F.lit("HTTPS://M.Example.COM:0/"), number),
    }
    variants = F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("url")) for k, v in forms.items()]))
    pages = t["pages"].select("page_id", "url").select("page_id", variants)
    return audit.url_audit(pages, "url", (".example.com", ".example.org"))


_ERRORS = """(
  select conv_id, turn, '(org.example.Failure' || turn || ')  ' || role || ' said' || chr(10) || text ||
    case conv_id % 5 when 0 then ' [PERMISSION_DENIED] on schema' when 1 then ' TEMPORARILY_UNAVAILABLE' when 2 then ' read timed out'
      when 3 then ' CATALOG_NOT_FOUND main' else '' end || ' JVM stacktrace: at line ' || turn || ' PERMISSION_DENIED?' as text
  from conversations)"""
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(f"""
select conv_id, turn, case when contains(text, 'INTERNAL_ERROR') or contains(text, 'TEMPORARILY_UNAVAILABLE') or contains(text, 'try again later')
    or contains(text, 'timed out') then 'temporary' when contains(text, 'PERMISSION_DENIED') then 'permission'
    when contains(text, 'NO_SUCH_CATALOG') or contains(text, 'CATALOG_NOT_FOUND') then 'missing' else 'other' end as "class",
  left(regexp_replace(trim(regexp_replace(split_part(text, 'JVM stacktrace', 1), '{_SPACE}', ' ', 'g'), ' '), '^\\([\\w.$]+\\)\\s*', ''), 200) as brief
from {_ERRORS}""")
def error_triage(t):
    """Every message as an error text with a class name, a marker and a stack trace."""
    kind = F.col("conv_id") % 5
    marker = (F.when(kind == 0, " [PERMISSION_DENIED] on schema").when(kind == 1, " TEMPORARILY_UNAVAILABLE")
              .when(kind == 2, " read timed out").when(kind == 3, " CATALOG_NOT_FOUND main").otherwise(""))
    turn = F.col("turn").cast("string")
    errors = t["conversations"].select("conv_id", "turn", F.concat(
        F.lit("(org.example.Failure"), turn, F.lit(")  "), "role", F.lit(" said\n"), "text", marker,
        F.lit(" JVM stacktrace: at line "), turn, F.lit(" PERMISSION_DENIED?")).alias("text"))
    return audit.error_triage(errors, "text").drop("text")


_NAMES = """(select event_id, 'pre-' || case when event_type = 'view' then user_id else epoch_us(ts) // 1000 end ||
             case when event_type = 'signup' then '-x' else '' end as name from events)"""


@query(f"""
select event_id, name, regexp_matches(name, '\\d{{13}}$')
    and {fx.NOW_SECONDS} - cast(nullif(regexp_extract(name, '(\\d{{13}})$', 1), '') as bigint) / 1000.0 > 1800 as stale
from {_NAMES}""")
def stale_names(t):
    stamp = F.floor(t.micros("events", "ts") / 1000)
    names = t["events"].select("event_id", F.concat(
        F.lit("pre-"), F.when(F.col("event_type") == "view", F.col("user_id")).otherwise(stamp).cast("string"),
        F.when(F.col("event_type") == "signup", "-x").otherwise("")).alias("name"))
    return audit.stale_names(names, "name", fx.NOW_SECONDS)


@query("""
select 'db' || user_id % 3 as database, count(*) filter (where event_type in ('view', 'click', 'purchase')) as busy from events
where user_id % 3 in (0, 1) group by 1""")
def open_sessions(t):
    """Every event is a session in one of three databases; two of them are to be moved."""
    state = (F.when(F.col("event_type") == "view", "active").when(F.col("event_type") == "click", "idle in transaction")
             .when(F.col("event_type") == "purchase", "idle in transaction (aborted)").otherwise("idle"))
    activity = t["events"].select(F.concat(F.lit("db"), (F.col("user_id") % 3).cast("string")).alias("database"), state.alias("state"))
    return audit.open_sessions(activity, ["db0", "db1"])
