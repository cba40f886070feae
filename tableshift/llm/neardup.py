"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

A signature has 4 symbols of 16 bits in each of m chunks; a symbol is the low bits of one minimum over the document's shingles.
By the pigeonhole principle, two signatures that differ in at most 2m-1 symbols have a chunk that differs in at most one. So
each chunk gives four keys, each with one symbol left out, and all pairs within the distance meet under a key. m is the
least for which a pair right at the similarity threshold is within the distance but for ``miss`` of all cases.

Pairs that meet are compared by whole signatures first, and links are confirmed on full shingle sets. Equal sets are one class
from the start. A bucket of any size is compared by pairs of blocks. Pairs of a group of copies are not sent one by one:

1. Each member of a bucket sends its nearest partner. Confirmed, these links join nearly all copies to their components.
2. Where close signatures still lie in different components, their documents form clusters of signatures. A cluster of any
   size is cut into blocks of bounded size, and each pair of blocks counts the shared shingles of all its pairs at once, on
   full sets. So every pair within the distance is decided, and only links between components are sent.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableshift.llm.bloom import blocked_bloom, may_contain
from tableshift.llm.components import components
from tableshift.llm.words import chunks, mix, runs
from tableshift.session import counted_step, cut_lineage, sized

WIDTH = 4  # symbols in a chunk
BLOCK_SETS, BLOCK_SHINGLES = 256, 1 << 19  # documents and shingles of a cluster's block, about


def chunks_needed(similarity: float, miss: float = 1e-7) -> int:
    """The least m for which 4m symbols of a pair at the threshold differ in over 2m-1 places with a chance of ``miss``."""
    m, p = 2, 1 - similarity
    while True:
        n = WIDTH * m
        tail = sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(2 * m, n + 1))
        if tail <= miss:
            return m
        m += 1


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text; A-Z lower-cased. Fewer words than ``width`` are one shingle."""
    for place, x in chunks(texts):
        words = x.hashes(lower=True)
        hashes = runs(words, width)
        for a, b in zip(x.firsts[:-1].tolist(), x.firsts[1:].tolist()):
            if b - a >= width:
                yield np.unique(hashes[a:b - width + 1])
            elif b > a:
                yield mix(runs(words[a:b], b - a) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray], symbols: int, seed: int) -> np.ndarray:
    """16-bit symbols, one row per set; empty sets give zeros."""
    random = np.random.Generator(np.random.PCG64(seed))
    factors = random.integers(1, 1 << 63, symbols, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    terms = random.integers(0, 1 << 63, symbols, dtype=np.uint64)
    out = np.zeros((len(sets), symbols), np.uint16)
    full = np.flatnonzero([len(s) for s in sets])
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        starts = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
        for k in range(symbols):
            least = np.minimum.reduceat(flat * factors[k] + terms[k], starts)
            out[full, k] = (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def keys_of(signature: np.ndarray) -> np.ndarray:
    """The keys of each signature: key ``4 * chunk + place`` leaves out that place of that chunk."""
    n, symbols = signature.shape
    out = np.empty((n, symbols), np.uint64)
    wide = signature.astype(np.uint64)
    for q in range(symbols):
        first = q - q % WIDTH
        packed = np.full(n, q + 1, np.uint64)
        for s in range(first, first + WIDTH):
            if s != q:
                packed = (packed << np.uint64(16)) | wide[:, s]
        out[:, q] = mix(packed) ^ np.uint64(q)
    return out.view(np.int64)


def _profile(docs: DataFrame, width: int, symbols: int, seed: int) -> DataFrame:
    """(doc_id, n, set_key, signature) per row of (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                sets = list(shingle_sets(some.column("text"), width))
                signed = signatures(sets, symbols, seed)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in signed], pa.binary())], ["doc_id", "n", "set_key", "signature"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n bigint, set_key binary, signature binary")


def _keyed(classes: DataFrame, symbols: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, symbols)
            keys = keys_of(signed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, symbols), pa.int32()), pa.array(keys.ravel()))],
                ["id", "keys"])
    return classes.select("id", "signature").mapInArrow(run, "id bigint, keys array<bigint>").select("id", F.posexplode("keys").alias("q", "key"))


def _differing(chunk: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which symbols of chunks differ, chunks given as 64-bit words: the top bit of each symbol that does."""
    low = np.uint64(0x7FFF_7FFF_7FFF_7FFF)
    either = chunk ^ other
    return (((either & low) + low) | either) & ~low


def _first_key(differ: np.ndarray) -> np.ndarray:
    """The first key that two signatures share, from where their chunks differ; -1 if none."""
    counts = np.bitwise_count(differ)
    near = counts <= 1
    chunk = near.argmax(axis=1)
    word = differ[np.arange(len(differ)), chunk]
    place = np.where(word == 0, 0, np.bitwise_count(word - np.uint64(1)) >> 4)
    return np.where(near.any(axis=1), WIDTH * chunk + place, -1)


def _close_pairs(rows: dict[str, np.ndarray], distance: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, symbols apart) of the close pairs in different components that meet first under the rows' own keys; ``a`` has the larger id."""
    group, signed = rows["group"], rows["signature"].view(np.uint64)
    left, found = np.arange(max(len(group) - 1, 0)), []
    for shift in range(1, len(group)):
        left = left[left + shift < len(group)]
        left = left[group[left] == group[left + shift]]
        if not len(left):
            break
        for k in range(0, len(left), 65_536):
            a = left[k:k + 65_536]
            b = a + shift
            small, large = np.minimum(rows["n"][a], rows["n"][b]), np.maximum(rows["n"][a], rows["n"][b])
            good = (100 * small >= percent * large) & (rows["component"][a] != rows["component"][b])
            good &= (rows["i"][a] == rows["j"][a]) | (rows["block"][a] != rows["block"][b])
            a, b = a[good], b[good]
            differ = _differing(signed[a], signed[b])
            apart = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
            close = apart <= distance
            a, b, apart = a[close], b[close], apart[close]
            mine = _first_key(differ[close]) == rows["q"][a]
            found.append((a[mine], b[mine], apart[mine]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    a, b, apart = map(np.concatenate, zip(*found))
    swap = rows["id"][a] < rows["id"][b]
    return np.where(swap, b, a), np.where(swap, a, b), apart


def _nearest(rows: dict[str, np.ndarray], distance: int, percent: int) -> pa.RecordBatch:
    """(key, i, j, a, b): each member's nearest partner; with null ``b``, the members of buckets that have more pairs."""
    a, b, apart = _close_pairs(rows, distance, percent)
    count = len(rows["id"])
    ids, rank = np.unique(rows["id"], return_inverse=True)
    best = np.full(count, np.iinfo(np.int64).max)
    np.minimum.at(best, a, apart * count + rank[b])
    pairs = np.bincount(a, minlength=count)
    sent = np.flatnonzero(pairs)
    more = np.zeros(int(rows["group"].max(initial=-1)) + 1, bool)
    more[rows["group"][pairs > 1]] = True
    member = pairs > 0
    member[b] = True
    members = np.flatnonzero(member & more[rows["group"]])
    at = np.concatenate((sent, members))
    partner = pa.array(np.concatenate((ids[best[sent] % count], np.zeros(len(members), np.int64))), mask=np.arange(len(at)) >= len(sent))
    return pa.RecordBatch.from_arrays([pa.array(rows[c][at]) for c in ("key", "i", "j", "id")] + [partner], ["key", "i", "j", "a", "b"])


def _stars(rows: dict[str, np.ndarray], distance: int, percent: int) -> pa.RecordBatch:
    """(a, b): links that join the close pairs of each bucket, at most one per member."""
    a, b, _ = _close_pairs(rows, distance, percent)
    least = spread(a, b, rows["id"])
    at = np.flatnonzero(least != rows["id"])
    return pa.RecordBatch.from_arrays([pa.array(rows["id"][at]), pa.array(least[at])], ["a", "b"])


def spread(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The least label that each place reaches along the pairs."""
    label = label.copy()
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        if (new == label).all():
            return label
        label = new


def _by_bucket(symbols: int, decide):
    """Apply ``decide`` to whole (key, i, j) groups of rows, which come sorted; many small groups at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy() for c in ("key", "i", "j", "q", "block", "id", "n", "component")}
            rows["signature"] = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, symbols)
            if kept is not None:
                rows = {c: np.concatenate((kept[c], rows[c])) for c in rows}
            change = (rows["key"][1:] != rows["key"][:-1]) | (rows["i"][1:] != rows["i"][:-1]) | (rows["j"][1:] != rows["j"][:-1])
            rows["group"] = np.concatenate(([0], np.cumsum(change)))
            last = int(np.searchsorted(rows["group"], rows["group"][-1]))  # the last group may go on in the next batch
            if last:
                yield decide({c: v[:last] for c, v in rows.items()})
            kept = {c: v[last:] for c, v in rows.items() if c != "group"}
        if kept is not None:
            yield decide({**kept, "group": np.zeros(len(kept["key"]), np.int64)})

    return run


def _shared_shingles(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many shingles each left set shares with each right set, by products of 0/1 matrices over the shingles of both sides."""
    out = np.zeros((len(left), len(right)), np.float32)
    flat = [np.concatenate(x) for x in (left, right)]
    rows = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)]
    both = np.intersect1d(*flat)
    places = []
    for values, row in zip(flat, rows):
        at = np.searchsorted(both, values)
        at[at == len(both)] = 0
        known = both[at] == values if len(both) else np.zeros(len(values), bool)
        order = np.argsort(at[known], kind="stable")
        places.append((at[known][order], row[known][order]))
    for k in range(0, len(both), width):
        dense = []
        for (at, row), side in zip(places, (left, right)):
            a, b = np.searchsorted(at, (k, k + width))
            matrix = np.zeros((len(side), width), np.float32)
            matrix[row[a:b], at[a:b] - k] = 1
            dense.append(matrix)
        out += dense[0] @ dense[1].T
    return out


def _decide_blocks(key: tuple, table: pa.Table, percent: int) -> pa.Table:
    """One pair of a cluster's blocks: (a, b), links between the components that are linked here, at most one per component and least reached."""
    i, j = key[1].as_py(), key[2].as_py()
    block, component = (table.column(c).to_numpy() for c in ("block", "component"))
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
    x, y = np.flatnonzero(block == i), np.flatnonzero(block == j)
    n = np.array([len(s) for s in sets])
    shared = _shared_shingles([sets[r] for r in x], [sets[r] for r in y]).astype(np.int64) if len(x) and len(y) else np.zeros((len(x), len(y)), np.int64)
    near = 100 * shared >= percent * (n[x][:, None] + n[y][None, :] - shared)
    near &= component[x][:, None] != component[y][None, :]
    a, b = np.nonzero(near)
    least = spread(x[a], y[b], component)
    at = np.flatnonzero(least != component)
    joined = np.unique(np.column_stack((component[at], least[at])), axis=0)
    return pa.table({"a": pa.array(joined[:, 0]), "b": pa.array(joined[:, 1])})


def _sets(docs: DataFrame, wanted: DataFrame, width: int, filter_blocks: int = 1 << 16) -> DataFrame:
    """(id, shingles) of the wanted documents. A blocked Bloom filter of the ids holds most other texts back from the join."""
    possible = may_contain(docs, "doc_id", blocked_bloom(wanted, "id", filter_blocks), filter_blocks).filter("bloom_hit")
    texts = possible.select(F.col("doc_id").alias("id"), "text").join(wanted, "id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), pa.array([s.tobytes() for s in shingle_sets(some.column("text"), width)], pa.binary())],
                    ["id", "shingles"])
    return cut_lineage(texts.mapInArrow(run, "id bigint, shingles binary"))


def _confirmed(pairs: DataFrame, count: int, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b), ``count`` of them, whose full sets are similar enough."""
    wanted = cut_lineage(sized(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), 2 * count))
    sets = _sets(docs, wanted, width)
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("left")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("right")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                shared = int((y[at] == x).sum()) if len(y) else 0
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good)), batch.column("b").filter(pa.array(good))], ["a", "b"])
    return cut_lineage(both.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5, id_column: str = "doc_id", text_column: str = "text",
                    block: int = 512, seed: int = 3, miss: float = 1e-7) -> DataFrame:
    """One row per input row: (doc_id, n_shingles, component_id, kept).

    Documents are linked when their sets of ``width``-word shingles have ``100 * shared >= percent * union``. A text with fewer
    words is one shingle; null, empty and blank texts have none and link with nothing, nor do rows with a null id (their
    component is null). Rows that repeat an id and a text carry the same values; an id that is the least of
    several different sets joins what is linked to any of them. Other columns are ignored,
    whatever their names; an empty table gives an empty result.
    """
    m = chunks_needed(percent / 100, miss)
    symbols, distance = WIDTH * m, 2 * m - 1
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    profile, total = counted_step(_profile(docs, width, symbols, seed))
    linkable = profile.filter("n > 0 and doc_id is not null")
    classes, distinct = counted_step(sized(linkable.groupBy("set_key").agg(
        F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("signature").alias("signature")), symbols * total))
    # An id that comes with several texts may be the least of several classes: it is one node with all their sets.
    nodes = cut_lineage(sized(classes.groupBy("id").agg(F.sum("n").alias("n")), distinct))
    narrow = _keyed(classes, symbols)
    sizes = cut_lineage(sized(narrow.groupBy("key").count().filter("count > 1")
                              .select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")), symbols * distinct))
    met = cut_lineage(sized(narrow.join(sizes, "key"), symbols * distinct))

    def buckets(component: DataFrame) -> DataFrame:
        return (met.join(classes.select("id", "n", "signature").join(component, "id"), "id")
                .withColumn("block", F.pmod(F.xxhash64("id", F.lit(seed)), F.col("blocks")).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
                .select("key", "i", "j", "q", "block", "id", "n", "component", "signature"))

    def decided(rows: DataFrame, decide, schema: str) -> tuple[DataFrame, int]:
        return counted_step(rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(
            _by_bucket(symbols, lambda group: decide(group, distance, percent)), schema))

    def joined(before: DataFrame, links: DataFrame) -> DataFrame:
        """(id, component) after links between components."""
        after = components(links).select(F.col("node").alias("component"), F.col("component").alias("least"))
        return cut_lineage(sized(before.join(after, "component", "left").select("id", F.coalesce("least", "component").alias("component")), distinct))

    own = nodes.select("id", F.col("id").alias("component"))
    found, sent = decided(buckets(own), _nearest, "key bigint, i int, j int, a bigint, b bigint")
    nearest, count = counted_step(sized(found.filter("b is not null").select("a", "b").distinct(), sent))
    merged = joined(own, _confirmed(nearest, count, docs, width, percent))
    waiting = found.filter("b is null").select("key", "i", "j", F.col("a").alias("id"))
    unresolved, open_buckets = counted_step(sized(waiting.join(merged, "id").groupBy("key", "i", "j").agg(
        F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("key", "i", "j"), sent))
    if open_buckets:
        stars, _ = decided(buckets(merged).join(unresolved, ["key", "i", "j"], "left_semi"), _stars, "a bigint, b bigint")
        clusters = cut_lineage(sized(components(stars).withColumnRenamed("component", "cluster").withColumnRenamed("node", "id")
                                     .join(merged, "id").join(nodes, "id"), distinct))
        parts = cut_lineage(sized(clusters.groupBy("cluster").agg(F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")), distinct))
        pairs = (clusters.join(_sets(docs, clusters.select("id"), width), "id").join(parts, "cluster")
                 .withColumn("block", F.pmod(F.xxhash64("id", F.lit(seed)), F.col("blocks")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "component", "shingles"))
        more, linked = counted_step(pairs.groupBy("cluster", "i", "j").applyInArrow(
            lambda key, table: _decide_blocks(key, table, percent), "a bigint, b bigint"))
        if linked:
            merged = joined(merged, more)
    known = cut_lineage(sized(classes.select("set_key", "id").join(merged, "id").select("set_key", "component"), 2 * distinct))
    in_class = linkable.join(known, "set_key", "left").select("doc_id", "n", "component")
    alone = profile.filter("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("component"))
    return in_class.unionByName(alone).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))
