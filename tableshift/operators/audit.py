"""Reports on ownership, access, leftovers, compatibility and names. They plan; nothing is deleted or granted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableshift.functions import text as tx
from tableshift.operators.graph import reach

OPEN_STATES = ("active", "idle in transaction", "idle in transaction (aborted)")  # fixed values


def ownership(tables: DataFrame, roles: DataFrame) -> DataFrame:
    """(database, table, owner): every table with the name of its owner, null if no role has its owner id."""
    return tables.join(roles, "owner_id", "left").select("database", "table", "owner")


def access_report(tables: DataFrame, direct: DataFrame, default: DataFrame, reader: str) -> DataFrame:
    """(database, table, owner, can_read) for one reader.

    ``tables`` has (database, table, owner, created); ``direct`` grants (database, table, grantee); ``default`` grants
    (database, owner, since, grantee) cover tables their owner creates later.
    """
    keys = ["database", "table"]
    granted = direct.filter(F.col("grantee") == reader).select(*keys).distinct().withColumn("direct", F.lit(True))
    # The earliest default grant of an owner covers everything a later one would.
    standing = (default.filter(F.col("grantee") == reader).groupBy("database", "owner").agg(F.min("since").alias("since")))
    can = F.coalesce("direct", F.lit(False)) | F.coalesce(F.col("created") > F.col("since"), F.lit(False))
    return (tables.join(granted, keys, "left").join(standing, ["database", "owner"], "left")
            .select("database", "table", "owner", can.alias("can_read")))


def effective_grants(grants: DataFrame, memberships: DataFrame) -> DataFrame:
    """(role, privilege) each role holds itself or through membership; ``memberships`` has (role, member)."""
    edges = memberships.select(F.col("role").alias("source"), F.col("member").alias("target")).distinct()
    return reach(grants.select("role", "privilege"), edges, "role", ["privilege"])


def missing_names(expected: DataFrame, actual: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected names that are absent, once each."""
    return expected.select(*on).distinct().join(actual.select(*on).distinct(), list(on), "left_anti")


def leftovers(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(name, state, action): expected (name, label) against found (name, label).

    Ours carries our label and may be deleted; a resource of that name with another label is not ours.
    """
    joined = expected.select("name", F.col("label").alias("ours")).join(
        found.select("name", F.col("label").alias("seen"), F.lit(True).alias("here")), "name", "left")
    state = (F.when(F.col("here").isNull(), "absent").when(F.col("seen").eqNullSafe(F.col("ours")), "ours")
             .otherwise("not ours"))
    return joined.select("name", state.alias("state")).withColumn(
        "action", F.when(F.col("state") == "ours", "delete").when(F.col("state") == "absent", "none").otherwise("leave"))


def version_key(version: Column) -> Column:
    """``17.11`` as comparable numbers, so that it comes after ``17.2``."""
    return F.transform(F.split(version, r"\."), lambda part: part.cast("int"))


def compatibility(required: DataFrame, available: DataFrame) -> DataFrame:
    """(feature, required, available, status) from (feature, version) rows used and offered; the highest of each counts."""
    def highest(df, name):
        return df.groupBy("feature").agg(F.max(F.struct(version_key(F.col("version")).alias("k"), "version")).alias(name))
    joined = highest(required, "r").join(highest(available, "a"), "feature", "left")
    status = (F.when(F.col("a").isNull(), "missing").when(F.col("a.k") < F.col("r.k"), "too old").otherwise("ok"))
    return joined.select("feature", F.col("r.version").alias("required"), F.col("a.version").alias("available"),
                         status.alias("status"))


def open_sessions(activity: DataFrame, databases: Sequence[str]) -> DataFrame:
    """(database, busy): sessions running a statement or holding a transaction open. Quiet means 0 everywhere."""
    busy = F.count_if(F.col("state").isin(*OPEN_STATES))
    return activity.filter(F.col("database").isin(*databases)).groupBy("database").agg(busy.alias("busy"))


def slug_collisions(people: DataFrame, address: str, identity: str) -> DataFrame:
    """(slug, people, with_id_collisions): slugs several people share, and whether adding the id tells them apart."""
    named = people.select(tx.slug(F.col(address)).alias("slug"), F.col(identity).cast("string").alias("id"))
    pairs = named.groupBy("slug", "id").agg(F.count(F.lit(1)).alias("n"))
    return (pairs.groupBy("slug").agg(F.sum("n").alias("people"), F.sum(F.col("n") - 1).alias("with_id_collisions"))
            .filter("people > 1"))


def url_audit(urls: DataFrame, url: str, suffixes: Sequence[str], blocked_prefix: str = "accounts.") -> DataFrame:
    """Add (problem, clean_url): why an address is refused, or the bare https host to use."""
    judged = urls.withColumn("problem", tx.url_problem(F.col(url), suffixes, blocked_prefix))
    return judged.withColumn("clean_url", F.when(F.col("problem") == "ok", tx.url_clean(F.col(url))))


def error_triage(errors: DataFrame, text: str) -> DataFrame:
    """Add (class, brief)."""
    return errors.withColumn("class", tx.error_class(F.col(text))).withColumn("brief", tx.error_brief(F.col(text)))


def stale_names(names: DataFrame, name: str, now_seconds: float, older_than: int = 1800) -> DataFrame:
    """Add ``stale``: the name ends in a millisecond stamp older than the limit."""
    return names.withColumn("stale", tx.is_stale(F.col(name), now_seconds, older_than))
