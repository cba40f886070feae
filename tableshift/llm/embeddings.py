"""Near-duplicate vectors: random-hyperplane sign hashing in several tables, exact cosines in double precision, components.

Vectors meet in a bucket when a table gives them the same signs. The number of signs follows the number of vectors, so
buckets stay small, and the number of tables follows from it, so that a pair right at the threshold is found with probability
``recall``. A bucket larger than ``block`` is cut into blocks that are compared pair by pair of blocks in separate tasks,
so every pair of a bucket of any size is compared, in bounded memory. Links are counted, not emitted: a pair is counted in the first table
that has it, and each block pair sends at most one row per vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableshift.llm.components import components
from tableshift.session import cut_lineage


def plan_tables(count: int, threshold: float, recall: float, per_bucket: int = 32) -> tuple[int, int]:
    """(signs per table, tables) for so many vectors of one label."""
    agree = 1 - math.acos(threshold) / math.pi
    signs = min(30, max(6, math.ceil(math.log2(max(count, 1) / per_bucket))))
    return signs, math.ceil(math.log(1 - recall) / math.log(1 - agree ** signs))


def _unit(vectors: list) -> np.ndarray:
    """Rows of length one, in doubles; scaled first, so that no square overflows."""
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _signs(x: np.ndarray, signs: int, tables: int, seed: int) -> np.ndarray:
    """The code of each row in each table."""
    planes = np.random.Generator(np.random.PCG64(seed)).standard_normal((x.shape[1], signs * tables))
    bits = (x @ planes >= 0).reshape(len(x), tables, signs)
    return bits @ (1 << np.arange(signs))


def _spread(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least id that each row can reach inside one block pair; ``left`` and ``right`` label rows and columns."""
    most = np.iinfo(np.int64).max
    while True:
        new_left = np.minimum(left, np.where(links, right, most).min(axis=1, initial=most))
        new_right = np.minimum(right, np.where(links, new_left[:, None], most).min(axis=0, initial=most))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def _first_here(mask: np.ndarray, a: np.ndarray, b: np.ndarray, table: int) -> np.ndarray:
    """The pairs that no earlier table has in one bucket."""
    for t in range(table):
        if not mask.any():
            break
        mask = mask & (a[:, t][:, None] != b[:, t][None, :])
    return mask


def _block_pair(key: tuple, table: pa.Table, threshold: float) -> pa.Table:
    """Compare one pair of blocks: (id, links counted here, least id it reaches here)."""
    t, i, j = key[0].as_py(), key[-2].as_py(), key[-1].as_py()
    table = table.sort_by("id")
    ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
    weight = table.column("weight").to_numpy()
    x = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(len(ids), -1)
    codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.int32).reshape(len(ids), -1)
    a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
    near = x[a] @ x[b].T >= threshold
    if i == j:
        np.fill_diagonal(near, False)
    rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    a, b, near = a[rows], b[columns], near[np.ix_(rows, columns)]
    counted = _first_here(near, codes[a], codes[b], t)
    left, right = _spread(near, ids[a], ids[b])
    out = [(ids[a], (counted * weight[b][None, :]).sum(axis=1), left)]
    if i != j:
        out.append((ids[b], (counted * weight[a][:, None]).sum(axis=0), right))
    parts = [np.concatenate(c).astype(np.int64) for c in zip(*out)]
    return pa.table({"id": parts[0], "links": parts[1], "root": parts[2]})


def near_vectors(vectors: DataFrame, threshold: float = 0.93, recall: float = 0.999, id_column: str = "vec_id",
                 vector_column: str = "embedding", label_column: str = "label", block: int = 1024, seed: int = 11) -> DataFrame:
    """One row per input row: (vec_id, n_links, component_id, kept).

    Vectors are compared when their labels are equal and not null and their lengths are equal. Vectors that are null,
    empty, zero or hold null or non-finite numbers link with nothing, nor do rows with a null id, which are their own component
    (null). Equal vectors are one vector with a weight until the end, so copies are never paired; a row that repeats
    counts as another vector. Other columns are ignored; an empty table gives an empty result.
    """
    v = F.col("v")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(label_column).cast("string").alias("label"),
                          F.col(vector_column).cast("array<double>").alias("v"))
    sound = F.coalesce(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
                       & F.col("label").isNotNull() & F.col("id").isNotNull(), F.lit(False))
    rows = rows.select("id", "label", "v", sound.alias("sound"))
    keys = [F.xxhash64("label", "v").alias("k1"), F.xxhash64("v", "label", F.lit(1)).alias("k2")]
    classes = cut_lineage(rows.filter("sound").select("id", "label", "v", *keys).groupBy("k1", "k2").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v"), F.first("label").alias("label"))
        .withColumnRenamed("least", "id"))
    largest = classes.groupBy("label", F.size("v")).count().agg(F.max("count")).first()[0] or 0
    signs, tables = plan_tables(largest, threshold, recall)

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("v").to_pylist()
            widths = np.fromiter(map(len, raw), np.int64, len(raw))
            for width in np.unique(widths).tolist():
                own = np.flatnonzero(widths == width)
                unit = _unit([raw[r] for r in own])
                codes = _signs(unit, signs, tables, seed).astype(np.int32)
                some = batch.take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("label"), pa.array([width] * len(own), pa.int32()), some.column("weight"),
                     pa.array([u.tobytes() for u in unit], pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()),
                     pa.array(list(codes), pa.list_(pa.int32()))], ["id", "label", "width", "weight", "unit", "codes", "code_list"])

    hashed = cut_lineage(classes.select("id", "label", "weight", "v").mapInArrow(
        prepare, "id bigint, label string, width int, weight bigint, unit binary, codes binary, code_list array<int>"))
    bucket = ["t", "label", "width", "code"]
    narrow = hashed.select("id", "label", "width", F.posexplode("code_list").alias("t", "code"))
    sizes = cut_lineage(narrow.groupBy(*bucket).count().filter("count > 1")
                        .select(*bucket, F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    wide = hashed.select("id", "label", "width", "weight", "unit", "codes", F.posexplode("code_list").alias("t", "code"))
    met = (wide.join(sizes, bucket).withColumn("block", F.pmod(F.xxhash64("id", F.lit(seed)), F.col("blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}))
    found = (met.select(*bucket, "i", "j", "block", "id", "weight", "unit", "codes").groupBy(*bucket, "i", "j")
             .applyInArrow(lambda key, table: _block_pair(key, table, threshold), "id bigint, links bigint, root bigint"))
    found = cut_lineage(found)
    linked = found.groupBy("id").agg(F.sum("links").alias("links"))
    comps = components(found.filter("id <> root").select("id", "root").distinct(), "id", "root").withColumnRenamed("node", "id")
    known = cut_lineage(classes.select("id", "k1", "k2", "weight").join(linked, "id", "left").join(comps, "id", "left").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "id").alias("component")))
    sound_rows = rows.filter("sound").select("id", *keys).join(known, ["k1", "k2"], "left").select("id", "links", "component")
    others = rows.filter("not sound").select("id", F.lit(0).cast("bigint").alias("links"), F.col("id").alias("component"))
    return sound_rows.unionByName(others).select(
        F.col("id").alias("vec_id"), F.col("links").alias("n_links"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"))
