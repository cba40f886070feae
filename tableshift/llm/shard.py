"""Sharding by sampled splitters: size-weighted key samples give quantile boundaries, records are partitioned by range, and
ranges that turn out overfull are subdivided. DataFrame functions only.

The order of records is (hash of the text, id), so equal texts are neighbours. Exact byte and row counts of the ranges then
place every record at its position in the whole order, and the shard is the position's share of all bytes. Only narrow rows
(id, size, two hashes) move; lists on the driver are bounded by the number of ranges.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableshift.session import cut_lineage

SLICE_BITS = 10


def _unit(seed: int, *columns: str) -> Column:
    """A uniform number in [0, 1) that depends only on the values."""
    return F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 11) / F.lit(float(1 << 53))


def _draw(keys: DataFrame, chance: Column, seed: int) -> list[tuple]:
    sample = keys.filter(_unit(seed, "text_hash", "doc_id") < chance).select("text_hash", "doc_id").collect()
    return sorted(((r[0], r[1] is not None, r[1] if r[1] is not None else 0) for r in sample))


def _by_range(keys: DataFrame, splitters: list[tuple]) -> DataFrame:
    """Add ``range``: how many splitters are at or below (text_hash, doc_id). Found in a table of hash slices."""
    low, step = -(1 << 63), 1 << (64 - SLICE_BITS)
    rows, hashes = [], [s[0] for s in splitters]
    for i in range(1 << SLICE_BITS):
        a = bisect_right(hashes, low + i * step - 1)
        b = bisect_right(hashes, low + (i + 1) * step - 1)
        rows.append((i, a, [(s[0], s[2] if s[1] else None) for s in splitters[a:b]]))
    table = keys.sparkSession.createDataFrame(
        rows, "slice int, base int, bounds array<struct<text_hash: bigint, doc_id: bigint>>")
    here = F.struct("text_hash", "doc_id")
    at = (F.shiftright("text_hash", 64 - SLICE_BITS) + F.lit(1 << (SLICE_BITS - 1))).cast("int")
    # One row per slice and one bound per range: small by construction.
    return (keys.withColumn("slice", at).join(F.broadcast(table), "slice")
            .withColumn("range", F.col("base") + F.size(F.filter("bounds", lambda b: b <= here)))
            .drop("slice", "base", "bounds"))


def _around_groups(keys: DataFrame, splitters: set[tuple], most_bytes: int, most_rows: int) -> set[tuple]:
    """The splitters; those inside a group of equal texts of at most so many bytes and rows are moved before the group."""
    hashes = keys.sparkSession.createDataFrame(sorted({(s[0],) for s in splitters}), "text_hash bigint")  # at most one row per splitter
    large = (keys.join(F.broadcast(hashes), "text_hash").groupBy("text_hash").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
             .filter((F.col("bytes") > most_bytes) | (F.col("rows") > most_rows)).select("text_hash").collect())
    cut = {r[0] for r in large}
    return {s if s[0] in cut else (s[0], False, 0) for s in splitters}


def shard_by_size(docs: DataFrame, shards: int = 16, id_column: str = "doc_id", text_column: str = "text",
                  ranges: int = 1024, oversample: int = 16, slack: float = 0.001,
                  least_rows: int = 8192) -> DataFrame:
    """One row per record: (doc_id, size, text_crc32, shard, slot), shards of nearly equal bytes.

    ``size`` is the text's UTF-8 bytes plus 1, so records without text count too. Equal texts stay in one shard unless they are more
    than ``slack`` of a shard's bytes, or more than a range's rows; four of the largest record are allowed beyond that, up to
    five times ``slack``. Larger groups are cut where a shard is full. So a shard is off by at most that allowance or one
    record. ``slot`` numbers a shard's records from 0.

    A null text is empty (checksum 0), a null id sorts first, repeated rows are placed one by one, other columns are
    ignored whatever their names. With fewer records than shards some shards are empty; an empty table gives an empty result.
    """
    raw = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    keys = cut_lineage(docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), (F.octet_length(raw) + 1).cast("bigint").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"), F.xxhash64(raw).alias("text_hash")))
    total, count, largest = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1)), F.max("size")).first()
    schema = "doc_id bigint, size bigint, text_crc32 bigint, shard int, slot bigint"
    if not count:
        return keys.sparkSession.createDataFrame([], schema)
    sample = _draw(keys, F.col("size") * F.lit(oversample * ranges / total), 0)
    full = max(least_rows, 2 * -(-count // ranges))  # a range of so many narrow rows is never overfull
    together = int(max(slack * total / shards, min(4 * largest, 5 * slack * total / shards)))
    splitters = sorted(_around_groups(keys, set(sample[oversample::oversample]), together, full))
    seed = 0
    while True:
        ranged = _by_range(keys, splitters)
        counts = {r[0]: (r[1], r[2]) for r in ranged.groupBy("range").agg(F.count(F.lit(1)), F.sum("size")).collect()}
        over = {k: rows for k, (rows, _) in counts.items() if rows > full}
        if not over:
            break
        # Many small records: sample these ranges by rows, ``oversample`` for each part they should have.
        seed += 1
        parts = keys.sparkSession.createDataFrame(
            [(k, oversample * (2 / full)) for k in over], "range int, chance double")
        inside = ranged.join(F.broadcast(parts), "range")
        more = _around_groups(keys, set(_draw(inside, F.col("chance"), seed)[oversample // 2::oversample]), together, full) - set(splitters)
        if not more:  # only repeated rows and whole groups are left together
            break
        splitters = sorted({*splitters, *more})
    order = sorted(counts)
    before = list(accumulate(((counts[k]) for k in order), lambda a, b: (a[0] + b[0], a[1] + b[1]), initial=(0, 0)))
    offsets = keys.sparkSession.createDataFrame(
        [(k, *before[i]) for i, k in enumerate(order)], "range int, rows_before bigint, bytes_before bigint")
    along = Window.partitionBy("range").orderBy("text_hash", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    equal = Window.partitionBy("range", "text_hash")
    through = equal.orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)
    # One row per range: small by construction.
    placed = ranged.join(F.broadcast(offsets), "range").withColumns({
        "until": F.col("bytes_before") + F.sum("size").over(along), "place": F.col("rows_before") + F.row_number().over(along) - 1,
        "group_bytes": F.sum("size").over(equal), "group_until": F.sum("size").over(through)})
    at = F.when(F.col("group_bytes") <= together, F.col("until") - F.col("group_until")).otherwise(
        F.col("until") - F.col("size"))
    share = F.call_function("div", at * shards, F.lit(total))
    placed = cut_lineage(placed.select("doc_id", "size", "text_crc32", "place", share.cast("int").alias("shard")))
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))
