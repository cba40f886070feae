"""Syncs and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableshift.functions.times import DAY, HOUR
from tableshift.operators import diff, slots, sync
from tableshift.queries import sqltext as q
from tableshift.queries.registry import query
from tableshift.sources import fixtures as fx
from tableshift.sources.versions import VersionStore
from tableshift.streaming import jobs

_COMMIT = 1_700_000_000_000_000


def _event_stream(t):
    """The events as a stream; their wall-clock stamps become moments in UTC, which watermarks need."""
    return _moments(t, jobs.read_files(t.spark, t.folder, t["events"].schema, "events.parquet"))


def _moments(t, events):
    return events.withColumn("ts", F.timestamp_micros(t.micros("events", "ts")))


@query(q.fingerprint("part", "part", "cast(1 as bigint) as version, '17' as source_version,") + " union all "
       + q.fingerprint("part", "(select * replace (p_size + 1 as p_size) from part)", "2, '18',"))
def sync_snapshot(t):
    """Two full refreshes of a keyed source; each records the source version it shows."""
    store = VersionStore(t.spark, digest={"exact": False})
    sync.snapshot_sync(t["part"], ["p_partkey"], store, "part", _COMMIT, 17)
    sync.snapshot_sync(t["part"].withColumn("p_size", F.col("p_size") + 1), ["p_partkey"], store, "part", _COMMIT + HOUR, 18)
    return store.manifest().select("version", F.col("tag").alias("source_version"), "rows", "digest")


@query(f"""
select p_partkey, p_name, p_size + 1 as p_size, '18' as source_version, true as current
from part where (select count(*) from part) = (select count(distinct p_partkey) from part)""")
def sync_moved(t):
    """A sync moved to a new target: refreshed there in full, and proven current against its source row by row."""
    source = t["part"].withColumn("p_size", F.col("p_size") + 1)
    old, new = VersionStore(t.spark), VersionStore(t.spark)
    sync.snapshot_sync(t["part"], ["p_partkey"], old, "part", _COMMIT, 17)
    sync.snapshot_sync(source, ["p_partkey"], new, "part", _COMMIT + HOUR, 18)
    tag = new.manifest().select(F.col("tag").alias("source_version"))  # one table
    differ = diff.differing_keys(source, new.read("part"), ["p_partkey"]).withColumn("differs", F.lit(True))
    return (new.read("part").join(differ, "p_partkey", "left").join(tag)
            .select("p_partkey", "p_name", "p_size", "source_version", F.col("differs").isNull().alias("current")))


@query("""
select user_id, arg_max(event_type, event_id) as event_type, arg_max(value, event_id) as value, max(event_id) as event_id
from events group by 1 having arg_max(event_type, event_id) <> 'error'""")
def sync_triggered(t):
    """The events arrive as a stream of row changes by user; errors delete. Run once, then read the copy."""
    stream = _event_stream(t).select("user_id", "event_type", "value", "event_id")
    copy = jobs.ChangeLogSync(t.spark, ["user_id"], "event_id", "event_type = 'error'", stream.schema)
    copy.start(stream).awaitTermination()
    return copy.current()


_POLLS = """(
  select event_id, user_id, epoch_us(ts) as "at",
    case event_type when 'purchase' then 'ONLINE' when 'view' then 'PROVISIONING' when 'click' then
      case when value < 0.5 then 'FAILED' else 'ONLINE_UPDATING' end end as state,
    cast(floor(value) as bigint) as n, case event_type when 'error' then 'other' when 'signup' then 'missing' end as error
  from events)"""


@query(f"""
with started as (select user_id, min("at") as started from {_POLLS} group by 1),
marked as (select *, case when error = 'other' then 'e' when error is null then 'g' end as mark from {_POLLS}),
counted as (
  select event_id, lag(mark, 1) over w as m1, lag(mark, 2) over w as m2 from marked where mark is not null
  window w as (partition by user_id order by "at", event_id)),
judged as (
  select p.user_id, p."at", p.event_id,
    case when error = 'other' and m1 = 'e' and m2 = 'e' then 'error' when contains(coalesce(state, 'unknown'), 'FAILED') then 'failed'
      when contains(coalesce(state, 'unknown'), 'ONLINE') and (case when error is null then n else 0 end) >= 60 then 'ready'
      when "at" - started > 864000000000 then 'timeout' end as outcome
  from {_POLLS} p join started using (user_id) left join counted using (event_id))
select s.user_id, coalesce(arg_min(outcome, ("at", event_id)), 'waiting') as outcome, min("at") as "at"
from started s left join (select * from judged where outcome is not null) j using (user_id) group by 1""")
def sync_ready(t):
    """Every event is one poll of its user's sync: how the waiting of each sync ended."""
    kind = F.col("event_type")
    polls = fx.events_log(t).select(
        "event_id", "user_id", "at",
        F.when(kind == "purchase", "ONLINE").when(kind == "view", "PROVISIONING")
        .when(kind == "click", F.when(F.col("value") < 0.5, "FAILED").otherwise("ONLINE_UPDATING")).alias("state"),
        F.floor("value").alias("rows"),
        F.when(kind == "error", "other").when(kind == "signup", "missing").alias("error"))
    return sync.sync_outcome(polls, "user_id", "at", "event_id", expected_rows=60, timeout_seconds=864_000)


@query(f"""
with newest as (select user_id, max(event_id) as newest from events group by 1),
synced as (select user_id, max(event_id) as synced from events where epoch_us(ts) <= {fx.NOW_MICROS + 15 * DAY} and event_type <> 'error' group by 1)
select user_id, newest, synced, newest - coalesce(synced, 0) as lag, newest is not distinct from synced as current
from newest left join synced using (user_id)""")
def sync_freshness(t):
    """Newest change of each user against the newest one the copy had seen near the end of the month."""
    log = fx.events_log(t)

    def newest(df):
        return df.groupBy("user_id").agg(F.max("event_id").alias("version"))
    return sync.freshness(newest(log), newest(log.filter((F.col("at") <= fx.NOW_MICROS + 15 * DAY) & (F.col("event_type") != "error"))),
                          ["user_id"])


@query(f"""
select event_id, user_id, event_type from events
where event_id > (select max(event_id) from events where epoch_us(ts) <= {fx.NOW_MICROS})""")
def late_writes(t):
    """Writes past the watermark taken at the pause."""
    log = fx.events_log(t)
    mark = log.filter(F.col("at") <= fx.NOW_MICROS).select(F.max("event_id"))
    return sync.late_writes(log, "event_id", mark).select("event_id", "user_id", "event_type")


@query("select event_id, user_id, event_type, epoch_us(ts) as at from events")
def stream_dedup(t):
    """Every event is delivered twice and counted once."""
    deliveries = _event_stream(t).union(_event_stream(t)).select("event_id", "user_id", "event_type", "ts")
    once = jobs.drain(jobs.without_resends(deliveries, ["event_id"], "ts", "1 hour"), "dedup")
    return once.select("event_id", "user_id", "event_type", F.unix_micros("ts").alias("at"))


@query("""
select epoch_us(date_trunc('day', ts)) as window_start, user_id % 5 as shard, count(*) as writes from events
group by 1, 2""")
def stream_windows(t):
    """Writes per day and shard: days whose window the stream closed, and those still open at its end."""
    def counted(events):
        return jobs.writes_per_window(events.select((F.col("user_id") % 5).alias("shard"), "ts"), "ts", "1 day", "1 hour", ["shard"])
    found = jobs.with_open(jobs.drain(counted(_event_stream(t)), "windows"), counted(_moments(t, t["events"])), ["window_start", "shard"])
    return found.select(F.unix_micros("window_start").alias("window_start"), "shard", "writes")


@query("""
select user_id, epoch_us(min(ts)) as session_start, epoch_us(max(ts) + interval 6 hours) as session_end, count(*) as writes
from (select *, sum(new) over (partition by user_id order by ts, event_id) as session from (
        select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 6 hours then 0 else 1 end as new
        from events))
group by user_id, session""")
def stream_sessions(t):
    """Bursts of writes by user: those the stream closed, and those still open at its end."""
    def bursts(events):
        return jobs.write_sessions(events.select("user_id", "ts"), ["user_id"], "ts", "6 hours", "1 hour")
    found = jobs.with_open(jobs.drain(bursts(_event_stream(t)), "sessions"), bursts(_moments(t, t["events"])), ["user_id", "session_start"])
    return found.select("user_id", F.unix_micros("session_start").alias("session_start"),
                        F.unix_micros("session_end").alias("session_end"), "writes")


@query("""
select event_id, user_id, epoch_us(ts) as at,
       epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts, event_id) as gap_micros,
       round((epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts, event_id)) / 1e6, 1) as gap_seconds from events""")
def write_gaps(t):
    log = fx.events_log(t).select("event_id", "user_id", "at")
    return (slots.write_gaps(log, ["user_id"], "at", ["event_id"])
            .withColumn("gap_seconds", F.round(F.col("gap_micros") / 1e6, 1)))


@query(f"""
select user_id, max(case when a <= {fx.NOW_MICROS} then a end) as last_before, min(case when a > {fx.NOW_MICROS} then a end) as first_after,
       min(case when a > {fx.NOW_MICROS} then a end) - max(case when a <= {fx.NOW_MICROS} then a end) as pause_micros
from (select user_id, epoch_us(ts) as a from events) group by 1""")
def pause_length(t):
    return slots.pause_length(fx.events_log(t), ["user_id"], "at", fx.NOW_MICROS)
