"""The given tables, and the second sides derived from them. Every derivation covers whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableshift.functions.canon import is_utc, micros
from tableshift.sources.sides import Side

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")

# A fixed "now" inside the range of the events: 2024-01-15 00:00:00 UTC.
NOW_SECONDS = 1_705_276_800
NOW_MICROS = NOW_SECONDS * 1_000_000


class Tables:
    """The Parquet tables of one folder, each read when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def micros(self, table: str, column: str):
        return micros(F.col(column), self[table].schema[column].dataType, is_utc(self[table]))


def drifted_orders(t: Tables) -> DataFrame:
    """The new side of ``orders``: some lost, some with another customer, some added."""
    o = t["orders"]
    key = F.col("o_orderkey")
    kept = o.filter(key % 97 != 0).withColumn(
        "o_custkey", F.when(key % 101 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))
    added = o.filter(key % 89 == 0).withColumn("o_orderkey", key + 1_000_000_000_000)
    return kept.unionByName(added)


def drifted_customer(t: Tables) -> DataFrame:
    """The new side of ``customer``: some balances lost."""
    return t["customer"].withColumn("c_acctbal", F.when(F.col("c_custkey") % 50 != 0, F.col("c_acctbal")))


def drifted_lineitem(t: Tables) -> DataFrame:
    """The new side of ``lineitem``: some rows lost, some doubled."""
    rows, key = t["lineitem"], F.col("l_orderkey")
    return rows.filter(key % 113 != 0).unionByName(rows.filter(key % 127 == 0))


def old_side(t: Tables) -> Side:
    return Side.of("old", {"sales": {n: t[n] for n in ("customer", "lineitem", "nation", "orders")},
                           "stock": {n: t[n] for n in ("part", "supplier")}})


def new_side(t: Tables) -> Side:
    return Side.of("new", {"sales": {"customer": drifted_customer(t), "lineitem": drifted_lineitem(t),
                                     "nation": t["nation"], "orders": drifted_orders(t)},
                           "stock": {"part": t["part"]}})


def events_log(t: Tables) -> DataFrame:
    """``events`` with its moment as microseconds."""
    return t["events"].select("event_id", t.micros("events", "ts").alias("at"), "user_id", "event_type", "value", "props")


def catalog_listing(t: Tables) -> DataFrame:
    """A catalog of (database, schema, table, kind, owner, size): one entry per part."""
    return t["part"].select(
        F.col("p_brand").alias("database"), F.col("p_type").alias("schema"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), F.col("p_partkey").cast("string")).alias("table"),
        F.when(F.col("p_size") % 5 == 0, "VIEW").otherwise("BASE TABLE").alias("kind"),
        F.when(F.col("p_size") > 40, "platform_admin").otherwise("app_owner").alias("owner"),
        F.col("p_size").cast("bigint").alias("size"))
