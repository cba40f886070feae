"""Moving: versions, exports, exclusions, listings, restores, reads as of a moment."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableshift.functions.times import DAY, HOUR, SECOND
from tableshift.operators import history, mutate
from tableshift.operators.constraints import ForeignKey, Rules
from tableshift.operators.slots import as_of_version
from tableshift.plans import move
from tableshift.queries import sqltext as q
from tableshift.queries.registry import query
from tableshift.sources import fixtures as fx
from tableshift.sources import versions as vs

_COMMIT = 1_700_000_040_000_000  # a whole minute
_LOOSE = {"exact": False}  # digests that the SQL can state
_PLATFORM = r" (cloud_admin|platform_admin)$|__db_system"


@query(f"""
with per_day as (select cast(floor(epoch_us(ts) / 86400000000) as bigint) as version, max(epoch_us(ts)) as committed_at, user_id % 7 as "table"
                 from events group by all)
select "table", max(version) as version, max(committed_at) as committed_at from per_day group by 1""")
def latest_version(t):
    """Each day of writes is a version of the tables written that day; the newest of each."""
    log = fx.events_log(t)
    per_day = (log.groupBy((F.col("user_id") % 7).alias("table"), F.floor(F.col("at") / F.lit(DAY)).alias("version"))
               .agg(F.max("at").alias("committed_at")))
    return vs.latest_versions(per_day, ["table"])


_ERROR = "event_type = 'error'"  # deletes the user's row
_DAY_BEFORE = fx.NOW_MICROS // DAY - 1


def _changes(t):
    """The events as changes of one row per user."""
    return fx.events_log(t).select("user_id", "event_type", "value", "at", "event_id")


def _state_sql(until: str) -> str:
    newest = ", ".join(f"arg_max({c}, (epoch_us(ts), event_id)) as {n}" for c, n in
                       (("event_type", "event_type"), ("value", "value"), ("epoch_us(ts)", '"at"'), ("event_id", "event_id")))
    return f"select * from (select user_id, {newest} from events where epoch_us(ts) <= {until} group by 1) where event_type <> 'error'"


@query(_state_sql(str(fx.NOW_MICROS - SECOND)))
def read_as_of(t):
    """Every user's row at a moment on a whole minute, which is taken for the second before it."""
    return history.state_as_of(_changes(t), ["user_id"], "at", fx.NOW_MICROS, tie=["event_id"], deleted=_ERROR, whole_minute_step=True)


@query(_state_sql(f"(select max(epoch_us(ts)) from events where epoch_us(ts) // {DAY} = {_DAY_BEFORE})"))
def read_snapshot(t):
    """Every user's row at the snapshot named for a day: its last write."""
    changes = _changes(t)
    day = F.floor(F.col("at") / F.lit(DAY))
    tags = changes.groupBy(F.concat(F.lit("day-"), day.cast("string")).alias("tag")).agg(F.max("at").alias("at"))
    return history.state_at_tag(changes, ["user_id"], "at", tags, f"day-{_DAY_BEFORE}", tie=["event_id"], deleted=_ERROR)


@query("""
select event_id, user_id, event_type, epoch_us(ts) as valid_from, lead(epoch_us(ts)) over (partition by user_id order by ts, event_id) as valid_to
from events""")
def validity(t):
    """From when to when each change of a user's row held."""
    found = history.validity(_changes(t), ["user_id"], "at", tie=["event_id"])
    return found.select("event_id", "user_id", "event_type", F.col("at").alias("valid_from"), "valid_to")


_WEEK = (fx.NOW_MICROS - 7 * DAY, fx.NOW_MICROS)
_AT = ", ".join(f"arg_max({c}, (epoch_us(ts), event_id)) filter (where epoch_us(ts) <= {m}) as {c}_{n}"
                for m, n in zip(_WEEK, "ab") for c in ("event_type", "value"))


@query(f"""
with s as (select user_id, {_AT} from events where epoch_us(ts) <= {_WEEK[1]} group by 1),
v as (select user_id, coalesce(event_type_a, 'error') <> 'error' as had, event_type_b <> 'error' as has, event_type_a, value_a, event_type_b, value_b from s)
select user_id, case when not had then 'insert' when not has then 'delete' else 'update' end as change,
    case when had then event_type_a end as old_type, case when had then value_a end as old_value,
    case when has then event_type_b end as new_type, case when has then value_b end as new_value
from v where (had or has) and (had <> has or event_type_a <> event_type_b or value_a is distinct from value_b)""")
def net_changes(t):
    """What became of each user's row within a week, in one pass."""
    found = history.net_changes(_changes(t), ["user_id"], "at", *_WEEK, tie=["event_id"], deleted=_ERROR)
    return found.select("user_id", "change", F.col("old.event_type").alias("old_type"), F.col("old.value").alias("old_value"),
                        F.col("new.event_type").alias("new_type"), F.col("new.value").alias("new_value"))


@query(f"""
select event_id, user_id, event_type, is_base from (
    select *, false as is_base from events where epoch_us(ts) >= {fx.NOW_MICROS} - 7 * {DAY}
    union all (select *, true from events where epoch_us(ts) < {fx.NOW_MICROS} - 7 * {DAY}
        qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1))
where not (is_base and event_type = 'error')""")
def history_window(t):
    """The changes that reading at any moment of a week needs."""
    found = history.within_history(_changes(t), ["user_id"], "at", fx.NOW_MICROS, tie=["event_id"], deleted=_ERROR)
    return found.select("event_id", "user_id", "event_type", "is_base")


@query("""
select m.event_id, m.user_id, v.event_id as version
from (select * from events where event_type <> 'purchase') m
asof left join (select * from events where event_type = 'purchase') v on m.user_id = v.user_id and m.ts >= v.ts""")
def as_of_versions(t):
    """Every write with the user's newest purchase at that moment."""
    log = fx.events_log(t)
    moments = log.filter("event_type <> 'purchase'").select("user_id", "at", "event_id")
    versions = log.filter("event_type = 'purchase'").select("user_id", "at", F.col("event_id").alias("version"))
    return as_of_version(moments, versions, ["user_id"], "at", "version").drop("at")


@query(f"""
with v as (select cast(floor(epoch_us(ts) / 3600000000) as bigint) as version, max(epoch_us(ts)) as committed_at,
                  bool_or(event_type = 'purchase' and value > 40) as no_expiry from events group by 1)
select version, committed_at, no_expiry,
       committed_at + 86400000000 < {fx.NOW_MICROS + 14 * DAY} and not no_expiry and version <> (select max(version) from v) as expired,
       committed_at >= {fx.NOW_MICROS + 14 * DAY} - 7 * 86400000000 as readable
from v""")
def retention_plan(t):
    log = fx.events_log(t)
    versions = log.groupBy(F.floor(F.col("at") / F.lit(HOUR)).alias("version")).agg(
        F.max("at").alias("committed_at"), F.bool_or((F.col("event_type") == "purchase") & (F.col("value") > 40)).alias("no_expiry"))
    return vs.retention_plan(versions, fx.NOW_MICROS + 14 * DAY)


_EXPORTED = ("customer", "lineitem", "orders", "part", "supplier")


@query(" union all ".join(q.fingerprint(n, n, f"cast(1 as bigint) as version, '{n}' as \"table\",") for n in _EXPORTED))
def export_manifest(t):
    store = vs.VersionStore(t.spark, digest=_LOOSE)
    store.export({n: t[n] for n in _EXPORTED}, _COMMIT)
    return store.manifest().select("version", "table", "rows", "digest")


@query(" union all ".join(q.fingerprint(n, n, f"'{n}' as \"table\", false as excluded,") for n in ("customer", "orders", "part")))
def export_excluded(t):
    """Tables that match a pattern stay out, and the manifest proves it."""
    patterns = ["^line", "^supp"]
    store = vs.VersionStore(t.spark, digest=_LOOSE)
    store.export({n: t[n] for n in _EXPORTED}, _COMMIT, exclude=patterns)
    return store.manifest().select("table", vs.matches_any(F.col("table"), patterns).alias("excluded"), "rows", "digest")


_PATTERNS = ("ring", "^blue_", "no such table", "_777777777$", "bolt_[0-9]+$", "^legacy_")


@query(" union all ".join(f"select '{p}' as pattern where not exists (select 1 from {q.LISTING} where regexp_matches(\"table\", '{p}'))"
                          for p in _PATTERNS))
def unmatched_exclusions(t):
    return vs.unmatched_patterns(fx.catalog_listing(t), "table", _PATTERNS)


@query("""
with recursive names as (select p_partkey as k, p_name || '_' || p_partkey as name from part),
hit as (select k from names where regexp_matches(name, '^blue')),
reached as (select k from hit union select e.k from (
    select p_partkey as k, p_partkey // 2 as needed from part where p_partkey > 0
    union select p_partkey, p_partkey // 3 from part where p_partkey > 0 and p_size % 2 = 0) e join reached on e.needed = reached.k)
select name, case when k in (select k from hit) then 'pattern' else 'depends' end as reason from reached join names using (k)""")
def dependent_exclusions(t):
    """Every part is a view over the part at half its key, and some also over the one at a third."""
    key, parts = F.col("p_partkey"), t["part"]
    names = parts.select(key.alias("k"), F.concat_ws("_", "p_name", key.cast("string")).alias("name"))
    halves = parts.filter(key > 0).select(key.alias("k"), F.floor(key / 2).alias("over"))
    thirds = parts.filter((key > 0) & (F.col("p_size") % 2 == 0)).select(key.alias("k"), F.floor(key / 3).alias("over"))
    below = names.select(F.col("k").alias("over"), F.col("name").alias("needed"))
    return move.excluded_names(names, "name", ["^blue"], halves.union(thirds).join(names, "k").join(below, "over").select("name", "needed"))


def _listing_lines(t):
    return fx.catalog_listing(t).select("database", F.concat_ws(" ", F.concat(F.col("size").cast("string"), F.lit("; 1259")),
                                                                "kind", "schema", "table", "owner").alias("line"))


_LINES = f"""(select database, size || '; 1259 ' || kind || ' ' || schema || ' ' || "table" || ' ' || owner as line from {q.LISTING})"""


@query(f"""
select database, case when regexp_matches(line, '{_PLATFORM}') then ';' || line else line end as line,
       regexp_matches(line, '{_PLATFORM}') as skipped,
       count(*) over (partition by database) as entries,
       count(*) filter (where regexp_matches(line, '{_PLATFORM}')) over (partition by database) as skipped_entries
from {_LINES}""")
def toc_filter(t):
    """Platform entries of each listing commented out, with the counts per database."""
    filtered = move.filter_listing(_listing_lines(t), "line", _PLATFORM)
    counts = move.listing_counts(filtered).withColumnRenamed("skipped", "skipped_entries")
    return filtered.join(counts, "database").select("database", "line", "skipped", "entries", "skipped_entries")


@query(q.fingerprint("customer", "customer", "'published' as outcome, 'customer' as \"table\",") + " union all "
       + q.fingerprint("orders", "orders", "'published', 'orders' as \"table\",")
       + " union all select 'refused', 'orders', count(*), 'none' from " + q.DRIFTED_ORDERS
       + " where o_custkey not in (select c_custkey from customer) having count(*) > 0")
def atomic_restore(t):
    """A restore that passes its rules is published whole; one with an order without a customer publishes nothing."""
    rules = {"orders": Rules(primary_key=["o_orderkey"],
                             foreign_keys=[ForeignKey(["o_custkey"], "customer", ["c_custkey"])])}
    source, target = vs.VersionStore(t.spark, digest=_LOOSE), vs.VersionStore(t.spark, digest=_LOOSE)
    source.export({"customer": t["customer"], "orders": t["orders"]}, _COMMIT)
    move.restore(source, target, _COMMIT + 1, rules=rules)
    source.export({"customer": t["customer"], "orders": fx.drifted_orders(t)}, _COMMIT + HOUR)
    published = target.manifest()
    result = published.select(F.lit("published").alias("outcome"), "table", "rows", "digest")
    try:
        move.restore(source, target, _COMMIT + 2 * HOUR, rules=rules)
    except vs.NotPublished:
        bad = fx.drifted_orders(t).join(t["customer"], F.col("o_custkey") == F.col("c_custkey"), "left_anti")
        count = bad.agg(F.count(F.lit(1)).alias("rows"))
        result = result.unionByName(count.select(F.lit("refused").alias("outcome"), F.lit("orders").alias("table"), "rows",
                                                 F.lit("none").alias("digest")))
    return result


@query("""
select c_custkey as database, min(epoch_us(o_orderdate)) as first_started, count(o_orderkey) as attempts
from customer left join orders on o_custkey = c_custkey
where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT')
group by 1""")
def pending_restores(t):
    """Every customer is a database, its orders are attempts, and a finished urgent order means it was restored."""
    orders = t["orders"]
    database = F.col("o_custkey").alias("database")
    done = orders.filter("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'").select(database)
    tried = orders.select(database, t.micros("orders", "o_orderdate").alias("started"))
    return move.pending_restores(t["customer"].select(F.col("c_custkey").alias("database")), done, tried)


@query("select s_suppkey, s_name, s_nationkey, s_acctbal, 'refused' as second_load from supplier")
def data_only_load(t):
    """Suppliers loaded into an empty table whose parents are there; loading them again is refused."""
    suppliers = t["supplier"]
    parent = (ForeignKey(["s_nationkey"], "nation", ["n_nationkey"]), t["nation"])
    empty = t.spark.createDataFrame([], suppliers.schema)
    store = vs.VersionStore(t.spark)
    store.export({"supplier": mutate.data_only_load(empty, suppliers, foreign_keys=[parent])}, _COMMIT)
    loaded = store.read("supplier")
    try:
        mutate.data_only_load(loaded, suppliers, foreign_keys=[parent])
        second = "accepted"
    except mutate.Rejected:
        second = "refused"
    return loaded.withColumn("second_load", F.lit(second))


_INCOMING = """(select o_orderkey * 2 as k from orders union all select o_orderkey * 2 from orders where o_orderpriority = '1-URGENT')"""


@query(f"""
select k as o_orderkey, 'exists' as reason, count(*) as copies from {_INCOMING} where k in (select o_orderkey from orders) group by 1
union all select k, 'repeats', count(*) from {_INCOMING} group by 1 having count(*) > 1""")
def collision_report(t):
    orders = t["orders"]
    doubled = orders.select((F.col("o_orderkey") * 2).alias("o_orderkey"), "o_orderpriority")
    incoming = doubled.unionByName(doubled.filter("o_orderpriority = '1-URGENT'"))
    return mutate.collisions(orders, incoming, ["o_orderkey"])


@query(f"""
select database, count(*) filter (where not regexp_matches("table", 'ring|^blue_')) as tables,
       count(*) filter (where regexp_matches("table", 'ring|^blue_')) as excluded,
       cast(coalesce(sum(case when not regexp_matches("table", 'ring|^blue_') then size end), 0) as bigint) as size,
       database not in (select p_brand from part group by 1 having max(p_retailprice) > 1090) as pending
from {q.LISTING} group by 1""")
def move_plan(t):
    published = t["part"].groupBy(F.col("p_brand").alias("database")).agg(F.max("p_retailprice").alias("m")).filter("m > 1090")
    return move.move_plan(fx.catalog_listing(t), published, ["ring", "^blue_"])
