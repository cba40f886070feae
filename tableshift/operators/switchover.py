"""After a switch: was every write kept, what reached the wrong side, how to bring it over, and which access rules to rebuild."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableshift.functions.text import any_of
from tableshift.operators.mutate import allocate_ids
from tableshift.session import cut_lineage
from tableshift.sources.sides import union_all


def write_continuity(sent: DataFrame, old: DataFrame, new: DataFrame, keys: Sequence[str], time: str, paused_at: int,
                     resumed_at: int) -> DataFrame:
    """(…keys, sent_at, on_old, on_new, outcome) of every write that a client saw succeed, and of every row that nobody sent.

    ``sent`` has the keys and moment of each acknowledged write. Up to the pause a write belongs on both sides (``carried``; else
    ``left behind`` on the old one), after the writers resumed on the new one (``served``; else ``stranded`` on the old one). A
    write that is on neither side is ``lost``, one within the pause should have been refused (``within the pause``), and a row without a
    write is ``unsent``. More rows than acknowledgements of the key on the new side are ``repeated``; a write without a moment is
    ``undated``. The three sides meet in one shuffle, counted inside tasks first, so a key that repeats sends few rows.
    """
    def side(df: DataFrame, name: str, at: Column) -> DataFrame:
        return df.select(*keys, F.lit(name).alias("_side"), at.cast("bigint").alias("_at"))

    nowhere = F.lit(None)
    met = union_all([side(sent, "s", F.col(time)), side(old, "o", nowhere), side(new, "n", nowhere)])
    count = {s: F.count_if(F.col("_side") == s) for s in "son"}
    counted = met.groupBy(*keys).agg(count["s"].alias("_sent"), F.max("_at").alias("sent_at"), count["o"].alias("on_old"),
                                     count["n"].alias("on_new"))
    at, on_old, on_new = F.col("sent_at"), F.col("on_old") > 0, F.col("on_new") > 0
    outcome = (F.when(F.col("_sent") == 0, "unsent")
               .when(~on_old & ~on_new, "lost")
               .when(F.col("on_new") > F.col("_sent"), "repeated")
               .when(at.isNull(), "undated")
               .when(at <= paused_at, F.when(on_new, "carried").otherwise("left behind"))
               .when(at < resumed_at, "within the pause")
               .when(on_new, "served").otherwise("stranded"))
    return counted.select(*keys, "sent_at", "on_old", "on_new", outcome.alias("outcome"))


def continuity_summary(outcomes: DataFrame) -> DataFrame:
    """(outcome, writes, first_at, last_at, kept): one row per outcome; only carried and served writes are where they belong."""
    return (outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("writes"), F.min("sent_at").alias("first_at"), F.max("sent_at").alias("last_at"))
            .withColumn("kept", F.col("outcome").isin("carried", "served")))


def rescue_ids(stranded: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(old_id, new_id, collides): fresh ids on the new side for rows that reached the old side after the switch.

    Both sides went on counting from the same id, so a stranded row's id may be taken, or be taken soon: each gets one past the new
    side's highest, in the order of the old ids. ``collides`` says the old id is taken now. Ids are given in parallel.
    """
    old = cut_lineage(stranded.select(F.col(key).alias("old_id")).distinct())
    numbered = allocate_ids(old, ["old_id"], "new_id", cut_lineage(new.agg(F.max(key))))
    taken = new.select(F.col(key).alias("old_id")).distinct().withColumn("collides", F.lit(True))
    return numbered.join(taken, "old_id", "left").select("old_id", "new_id", F.coalesce("collides", F.lit(False)).alias("collides"))


def with_rescued_ids(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` holds a rescued id, with the new id in its place: the rows themselves, or the children that refer to them."""
    renamed = ids.select(F.col("old_id").alias(column), "new_id")
    joined = rows.join(renamed, column)
    return joined.withColumn(column, F.col("new_id")).select(*rows.columns)


def rescue(stranded: DataFrame, new: DataFrame, key: str, children: Mapping[str, tuple[DataFrame, str]] | None = None
           ) -> tuple[DataFrame, dict[str, DataFrame], DataFrame]:
    """(rows to append to ``new``, rows to append to each child table, the ids): stranded rows under fresh ids, and their children.

    ``children`` names stranded child rows and the column that refers to ``key``. Children of rows that were carried keep
    their reference and are not part of this. Nothing is written.
    """
    ids = cut_lineage(rescue_ids(stranded, new, key))
    return (with_rescued_ids(stranded, ids, key),
            {name: with_rescued_ids(rows, ids, column) for name, (rows, column) in (children or {}).items()}, ids)


def quoted(name: Column) -> Column:
    """A name as an SQL identifier; PUBLIC, which is every role, is a word and stays bare."""
    return F.when(name == "PUBLIC", name).otherwise(F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"')))


def _lacking(old: DataFrame, new: DataFrame, columns: Sequence[str], system: Sequence[str], roles: Sequence[str]) -> DataFrame:
    """What the old side has and the new one lacks, without the platform's own roles."""
    wanted = old.select(*columns).distinct().join(new.select(*columns).distinct(), list(columns), "left_anti")
    return wanted.filter(~any_of([F.col(r).rlike(p) for r in roles for p in system])) if system else wanted


def access_rebuild(old: Mapping[str, DataFrame], new: Mapping[str, DataFrame], system: Sequence[str] = ()) -> DataFrame:
    """(step, database, statement): what to run on the new side, step by step, so that its access rules equal the old side's.

    A side is a mapping of frames: ``roles`` (role), ``members`` (role, member), ``owners`` (database, schema, table, owner), ``grants``
    (database, schema, table, grantee, privilege) and ``defaults`` (database, schema, owner, grantee, privilege). Roles that match a
    pattern of ``system`` are the platform's and are left alone. Tables change hands only where the new side has them; the new
    owner gets CREATE in the schema for that step and loses it after.

    Steps: 1 roles, 2 memberships, 3 CREATE for new owners, 4 owners, 5 CREATE taken back, 6 grants, 7 default privileges. This is a
    plan: nothing is run. Rows with a null name are left out.
    """
    def text(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    def step(number: int, df: DataFrame, statement: Column, database: Column | None = None) -> DataFrame:
        where = F.lit(None).cast("string") if database is None else database.cast("string")
        return df.select(F.lit(number).alias("step"), where.alias("database"), statement.alias("statement")).filter("statement is not null")

    def name(column: str) -> Column:
        return quoted(F.col(column))

    roles = _lacking(old["roles"], new["roles"], ["role"], system, ["role"])
    members = _lacking(old["members"], new["members"], ["role", "member"], system, ["role", "member"])
    place = ["database", "schema", "table"]
    here = new["owners"].select(*place).distinct()
    owners = cut_lineage(_lacking(old["owners"], new["owners"], [*place, "owner"], system, ["owner"]).join(here, place, "left_semi"))
    schemas = owners.select("database", "schema", "owner").distinct()
    grants = _lacking(old["grants"], new["grants"], [*place, "grantee", "privilege"], system, ["grantee"]).join(here, place, "left_semi")
    by = ["database", "schema", "owner", "grantee", "privilege"]
    defaults = _lacking(old["defaults"], new["defaults"], by, system, ["owner", "grantee"])
    table = text(name("schema"), ".", name("table"))
    db = F.col("database")
    return union_all([
        step(1, roles, text("CREATE ROLE ", name("role"))),
        step(2, members, text("GRANT ", name("role"), " TO ", name("member"))),
        step(3, schemas, text("GRANT CREATE ON SCHEMA ", name("schema"), " TO ", name("owner")), db),
        step(4, owners, text("ALTER TABLE ", table, " OWNER TO ", name("owner")), db),
        step(5, schemas, text("REVOKE CREATE ON SCHEMA ", name("schema"), " FROM ", name("owner")), db),
        step(6, grants, text("GRANT ", F.col("privilege"), " ON ", table, " TO ", name("grantee")), db),
        step(7, defaults, text("ALTER DEFAULT PRIVILEGES FOR ROLE ", name("owner"), " IN SCHEMA ", name("schema"), " GRANT ",
                               F.col("privilege"), " ON TABLES TO ", name("grantee")), db)])
