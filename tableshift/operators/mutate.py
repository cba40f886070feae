"""Table changes as new frames: nothing is updated in place, so the old rows stay readable until the new are published."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableshift.operators.constraints import ForeignKey, orphans
from tableshift.operators.diff import duplicate_keys
from tableshift.session import cut_lineage, work_folder
from tableshift.sources.sides import union_all


class Rejected(ValueError):
    """A load that would break the target; nothing of it is applied."""


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool = False) -> DataFrame:
    """One row per key: its first (or last) in the order, by an aggregate that also combines inside tasks."""
    pick = F.max_by if last else F.min_by
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return chosen.select(*keys, *[f"_row.{c}" for c in rest]).select(*df.columns)


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The target plus the batch rows whose key it lacks; of several batch rows with one key, the first in order."""
    fresh = first_per_key(batch, keys, order).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def seed_if_empty(target: DataFrame, seed: DataFrame) -> DataFrame:
    """The seed rows if the target has none, else the target as it is."""
    return seed.select(*target.columns) if target.isEmpty() else target


def predicate_update(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns where a condition is true; where it is unknown nothing changes."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def keyed_update(df: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Set the columns ``updates`` carries on the rows with its keys (NULL included); its last row per key wins."""
    keys = list(keys)
    columns = [c for c in updates.columns if c not in keys and c in df.columns]
    last = first_per_key(updates, keys, order, last=True)
    last = last.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = df.join(last, keys, "left")
    hit = F.col("_hit").isNotNull()
    return joined.withColumns({c: F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}).select(*df.columns)


def collisions(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(…keys, reason, copies): keys the target already has, and keys that repeat in the batch."""
    counted = incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    held = counted.join(target.select(*keys), list(keys), "left_semi").withColumn("reason", F.lit("exists"))
    repeated = counted.filter("copies > 1").withColumn("reason", F.lit("repeats"))
    return held.unionByName(repeated).select(*keys, "reason", "copies")


def checked_append(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with the batch appended, or ``Rejected`` and no change if any key collides."""
    if not collisions(target, incoming, keys).isEmpty():
        raise Rejected(f"duplicate key on {', '.join(keys)}")
    return target.unionByName(incoming.select(*target.columns))


def data_only_load(target: DataFrame, incoming: DataFrame, *, foreign_keys: Sequence[tuple[ForeignKey, DataFrame]] = (),
                   leave_out: Column | None = None) -> DataFrame:
    """Load rows into an existing, empty table with the same columns whose parents are already there.

    ``leave_out`` drops incoming rows, for instance ledger rows the target writes itself.
    """
    if not target.isEmpty():
        raise Rejected("the target already has rows; loading again would double them")
    if [(f.name, f.dataType) for f in target.schema] != [(f.name, f.dataType) for f in incoming.schema]:
        raise Rejected("the target's columns differ from the incoming ones")
    if leave_out is not None:
        incoming = incoming.filter(~F.coalesce(leave_out, F.lit(False)))
    for fk, parent in foreign_keys:
        if not orphans(incoming, parent, fk).isEmpty():
            raise Rejected(f"rows without a parent in {fk.parent}")
    return target.unionByName(incoming)


def smoke_write(target: DataFrame, probe: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Write probe rows beside the table, read them back with it, and publish nothing.

    One row: (rows_before, rows_with_probe, rows_after, smoke_ok). Three reads count: the table before the probe is written,
    the table with the probe, and the table again afterwards; it is well if the probe was seen and the table
    did not change. No generated id is used up.
    """
    before = cut_lineage(target.agg(F.count(F.lit(1)).alias("n")))
    path = work_folder(target.sparkSession, "smoke")
    probe.select(*target.columns).write.parquet(path)
    written = target.sparkSession.read.schema(target.schema).parquet(path)
    together = target.unionByName(written).join(probe.select(*keys, F.lit(True).alias("#probe")).distinct(), list(keys), "left")
    counts = cut_lineage(together.agg(F.count(F.lit(1)).alias("with_probe"), F.count("`#probe`").alias("seen"))
                         .crossJoin(written.agg(F.count(F.lit(1)).alias("written"))))  # one row each
    counts = union_all([before.select(F.lit("before").alias("what"), "n"),
                        counts.select(F.lit("with_probe").alias("what"), F.col("with_probe").alias("n")),
                        counts.select(F.lit("unseen").alias("what"), (F.col("written") - F.col("seen")).alias("n")),
                        target.agg(F.count(F.lit(1)).alias("n")).select(F.lit("after").alias("what"), "n")])

    def of(what):
        return F.max(F.when(F.col("what") == what, F.col("n")))
    return (counts.agg(of("before").alias("rows_before"), of("with_probe").alias("rows_with_probe"), of("after").alias("rows_after"),
                       ((of("unseen") == 0) & (of("before") == of("after"))).alias("smoke_ok")))


def add_column(df: DataFrame, name: str, data_type: str) -> DataFrame:
    """A new column that is NULL in every existing row; a column that is already there stays as it is."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(data_type))


def allocate_ids(batch: DataFrame, order: Sequence[str], id_column: str, after: int | DataFrame) -> DataFrame:
    """Number a batch ``after + 1, after + 2, …`` in the given (unique) order, in parallel.

    ``after`` is a number or a one-row frame with the high-water mark. Rows are spread by ranges of the order, numbered
    inside each range and written to the shared folder, which fixes the ranges; only one count per range is summed in
    one place. The numbers depend on the order alone, not on how the ranges fall.
    """
    spark = batch.sparkSession
    path = work_folder(spark, "ids")
    local = F.expr("monotonically_increasing_id() & 8589934591")  # the low 33 bits number a task's rows from 0
    ranged = batch.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumns({"_range": F.spark_partition_id(), "_local": local}).write.parquet(path)
    pieces = spark.read.parquet(path)
    sizes = pieces.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    numbered = pieces.join(offsets, "_range")  # one row per range: small enough to be broadcast by its measured size
    high = F.coalesce(after.scalar(), F.lit(0)) if isinstance(after, DataFrame) else F.lit(after)
    return numbered.withColumn(id_column, high + F.col("_offset") + F.col("_local") + 1).select(id_column, *batch.columns)


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], version: str, deleted: Column) -> DataFrame:
    """The target after a batch of row changes: the newest change per key wins, a delete removes the row."""
    flagged = changes.withColumn("_gone", deleted)
    last = first_per_key(flagged, keys, [version], last=True)
    kept = target.join(last.select(*keys), list(keys), "left_anti")
    return kept.unionByName(last.filter(~F.col("_gone")).select(*target.columns))
