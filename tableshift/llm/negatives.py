"""Hard negatives by the threshold algorithm: sorted lists per dimension, random access for scores, an early and exact stop.

Anchors are a stated set of queries against all rows. Rows are cut into blocks and anchors into chunks, both of bounded bytes, and each
pair of a block and a chunk is one group. In a block, every dimension has a list of the rows sorted by it. An
anchor goes down the lists together, from the end its own sign prefers, and scores each row it meets for the first time. Below the depth reached
no row can score more than the threshold, the anchor's product with the last values seen; a block is left once the threshold is
strictly below the kth score of every window wanted (or below the window). Ties at the kth score are therefore all met.

A first pass finds each anchor's best rows of its own label, a second one the best rows of other labels inside a window of scores per
positive. Each pass keeps k rows per window of a block, and a ranking over blocks the final ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableshift.session import cut_lineage

#: Depths of sorted access between two looks at the threshold grow by this factor.
GROWTH = 2
_LONG = np.iinfo(np.int64)


class SortedLists:
    """The rows of a block, and per dimension their order by it."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        self.order = np.argsort(x, axis=0, kind="stable")
        self.most = float(np.abs(x).max(initial=0))
        self._whole: np.ndarray | None = None

    def exact(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and anchor in numbers whose products are exact: doubles while all sums stay below 2**53, else Python's integers."""
        if float(np.abs(anchor).max(initial=0)) * self.most * max(1, len(anchor)) < 2.0 ** 53:
            return self.x, anchor
        if self._whole is None:
            self._whole = np.frompyfunc(int, 1, 1)(self.x)
        return self._whole, np.frompyfunc(int, 1, 1)(anchor)

    def search(self, anchor: np.ndarray, wanted: np.ndarray, windows: list[tuple], k: int, first: int = 16) -> tuple[list[np.ndarray], int]:
        """(the best ``k`` wanted rows of each window (low, high) by score, then id; the number of rows scored)."""
        x, a = self.exact(anchor)
        n, dims = len(x), np.flatnonzero(anchor)
        if not wanted.any():
            return [np.zeros((0, 2), np.int64)] * len(windows), 0
        up, down = dims[anchor[dims] > 0], dims[anchor[dims] < 0]
        seen, rows, scores, depth = np.zeros(n, bool), [], [], 0
        while depth < n:
            reach = min(n, max(first, depth * GROWTH))
            met = np.zeros(n, bool)
            met[self.order[n - reach:n - depth, up]] = True
            met[self.order[depth:reach, down]] = True
            if not len(dims):
                met[:] = True
            new, depth = np.flatnonzero(met & ~seen), reach
            seen[new] = True
            rows.append(new[wanted[new]])
            scores.append(x[rows[-1]] @ a)
            if not len(dims) or seen.all():
                break
            # Rows not met yet have at most the last value met in each list, in the anchor's direction.
            bound = x[self.order[n - depth, up], up] @ a[up] + x[self.order[depth - 1, down], down] @ a[down]
            every = np.concatenate(scores)
            if all(low > bound or _kth(every, low, high, k, bound) for low, high in windows):
                break
        rows, scores = np.concatenate(rows), np.concatenate(scores)
        return [_best(rows, scores, self.ids, low, high, k) for low, high in windows], int(seen.sum())


def _kth(scores: np.ndarray, low: float, high: float, k: int, bound: float) -> bool:
    """Whether ``k`` scores of the window are strictly above the bound."""
    return int(((scores > bound) & (scores >= low) & (scores <= high)).sum()) >= k


def _best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, low: float, high: float, k: int) -> np.ndarray:
    """(id, score) of the best ``k`` of a window."""
    inside = np.flatnonzero((scores >= low) & (scores <= high))
    best = inside[np.lexsort((ids[rows[inside]], -scores[inside]))[:k]]
    return np.column_stack((ids[rows[best]], np.clip(scores[best], _LONG.min, _LONG.max).astype(np.int64)))


def _matrix(packed: pa.Array) -> tuple[pa.StructArray, np.ndarray]:
    """The rows of a packed group, and their components as whole numbers in doubles."""
    rows = packed.flatten()
    values = rows.field("v").flatten().to_numpy(zero_copy_only=False)
    return rows, values.reshape(len(rows), -1)


def _packed(table: pa.Table) -> pa.Array:
    column = table.column("rows")
    return pa.concat_arrays(column.chunks)


def _cell(blocks: pa.Table, chunk: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """One block against one chunk of anchors: (anchor, anchor_label, positive, positive_score, id, score).

    Without positives, rows of the anchor's label are looked for; with them, rows of other labels whose score is
    ``low`` to ``high`` percent of each positive's.
    """
    if not len(blocks) or not len(chunk):
        return pa.table({c: pa.array([], pa.string() if c == "anchor_label" else pa.int64())
                         for c in ("anchor", "anchor_label", "positive", "positive_score", "id", "score")})
    rows, x = _matrix(_packed(blocks))
    coded = rows.field("label").dictionary_encode()
    codes = {label: i for i, label in enumerate(coded.dictionary.to_pylist())}
    lists = SortedLists(rows.field("id").to_numpy(), coded.indices.to_numpy(), x)
    anchors, vectors = _matrix(_packed(chunk))
    mining = "positives" in [f.name for f in anchors.type]
    owners, found = [], []
    for i, (anchor, label) in enumerate(zip(anchors.field("id").to_pylist(), anchors.field("label").to_pylist())):
        same = lists.labels == codes.get(label, -1)
        if mining:
            positives = anchors.field("positives")[i].as_py()
            # 100 * score within low * positive and high * positive, in whole numbers
            windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in positives]
            best, _ = lists.search(vectors[i], ~same, windows, k)
            owners += [(anchor, label, p["id"], p["score"]) for p in positives]
        else:
            best, _ = lists.search(vectors[i], same & (lists.ids != anchor), [(-np.inf, np.inf)], k)
            owners.append((anchor, label, None, None))
        found += best
    counts, every = [len(f) for f in found], np.concatenate(found)
    columns = [pa.array(c, t).take(pa.array(np.repeat(np.arange(len(owners)), counts)))
               for c, t in zip(zip(*owners), (pa.int64(), pa.string(), pa.int64(), pa.int64()))]
    return pa.table([*columns, pa.array(every[:, 0]), pa.array(every[:, 1])],
                    ["anchor", "anchor_label", "positive", "positive_score", "id", "score"])


def _grid(blocks: DataFrame, chunks: DataFrame, k: int, low: int = 0, high: int = 0) -> DataFrame:
    """Every block against every chunk of its width."""
    def run(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        return _cell(a, b, k, low, high)

    left = blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    right = chunks.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["width", "block", "chunk"]
    return left.select(*keys, "rows").groupBy(*keys).cogroup(right.select(*keys, "rows").groupBy(*keys)).applyInArrow(
        run, "anchor bigint, anchor_label string, positive bigint, positive_score bigint, id bigint, score bigint")


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` per group by score, then id, with their ``rank``; Spark keeps ``k`` per task before it shuffles."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
                   block_bytes: int = 8 << 20, most_anchors: int = 4096) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x), with x as a double, and scores are exact integer inner products; a score beyond 64 bits is ordered
    exactly and returned as the nearest 64-bit number. An anchor's positives are its first ``positives`` other rows of its
    label, by higher score, then smaller id. For each of them, the first ``negatives`` rows of other labels follow whose
    score is between ``low`` and ``high`` percent of the positive's, both included, so a negative positive score has none.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. Rows that repeat an id are one row,
    the one with the least (label, vector). Vectors of different lengths don't meet; empty vectors score 0 with each
    other. ``is_anchor`` is a condition on the input's columns (null: no). Other columns are ignored, whatever their names; an empty
    table, or one without anchors, gives an empty result.

    ``block_bytes`` and ``most_anchors`` bound a group: the bytes of a block's components, and the anchors of a chunk.
    """
    v, largest = F.col("v"), float(np.finfo(np.float64).max)

    def whole(c: Column) -> Column:
        scaled = F.least(F.greatest(c * float(scale), F.lit(-largest)), F.lit(largest))
        return F.when(F.abs(scaled) < 2.0 ** 52, F.floor(scaled).cast("double")).otherwise(scaled)  # beyond, doubles are whole

    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(label_column).cast("string").alias("label"),
                          F.col(vector_column).cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    sound = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull()
                        & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    # Copies of a row meet in their task before the shuffle, so a repeated id sends few.
    once = sound.groupBy("id").agg(F.min(F.struct("label", "v", "anchor")).alias("r")).select("id", "r.*")
    once = cut_lineage(once.select("id", "label", "anchor", F.size("v").alias("width"), F.transform("v", whole).alias("v")))
    per_block = F.greatest(F.lit(1), F.lit(block_bytes) / (8 * F.greatest("width", F.lit(1))))
    sizes = once.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("m")).filter("m > 0").select(
        "width", "m", F.ceil(F.col("n") / per_block).cast("int").alias("blocks"))
    # Chunks fill the cluster where blocks alone don't.
    chunks = F.greatest(F.ceil(F.col("m") / most_anchors),
                        F.least("m", F.ceil(F.lit(vectors.sparkSession.sparkContext.defaultParallelism) / F.col("blocks"))))
    sizes = cut_lineage(sizes.select("width", "blocks", chunks.cast("int").alias("chunks")))
    placed = once.join(sizes, "width").withColumns({
        "block": F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"),
        "chunk": F.pmod(F.xxhash64("id", F.lit(1)), F.col("chunks")).cast("int")})
    blocks = cut_lineage(placed.groupBy("width", "block", "chunks").agg(F.collect_list(F.struct("id", "label", "v")).alias("rows")))
    anchors = placed.filter("anchor").select("width", "blocks", "chunk", "id", "label", "v")
    chunked = anchors.groupBy("width", "chunk", "blocks").agg(F.collect_list(F.struct("id", "label", "v")).alias("rows"))
    best = cut_lineage(_first(_grid(blocks, chunked, positives), ["anchor"], positives))
    own = best.groupBy(F.col("anchor").alias("id")).agg(F.collect_list(F.struct("id", "score")).alias("positives"))
    chunked = anchors.join(own, "id").groupBy("width", "chunk", "blocks").agg(
        F.collect_list(F.struct("id", "label", "v", "positives")).alias("rows"))
    met = _first(_grid(blocks, chunked, negatives, low, high), ["anchor", "positive"], negatives)
    return met.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
                      F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

