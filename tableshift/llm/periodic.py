"""Periodic runs of words: an enhanced suffix array and the branching-tandem test.

A run with period q ends where the period breaks, so its last square (2q words) is a *branching tandem*: positions i and i+q share
exactly q words. Both then lie in one LCP interval of depth q and in different children of it. For each interval only the suffixes
outside its largest child are tested, forwards and backwards, by looking up the interval of ISA[i+q] and ISA[i-q];
that is O(n log n) tests. No tree is built: intervals come from one pass over the LCP array. A tandem is then rotated to the left
as long as the period holds, which gives the run.

Documents are independent: symbols carry their document, so one array serves all documents of a chunk. Documents without two equal
stretches of the length that any run must repeat have no run, and are not indexed at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableshift.llm.words import Texts, chunks, mix, runs, within

#: Suffixes tested at a time.
TESTS = 1 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_SQL = "struct<start:bigint, length:bigint, period:bigint>"


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix of each with the one before it; the first has 0), by prefix doubling.

    Only groups of suffixes that are still equal are sorted again. The ranks of every doubling are kept to read the common prefixes from.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    rank, levels = np.full(n + 1, -1, np.int64), []
    slots, key, h = np.arange(n), codes[order].astype(np.int64), 1
    while len(slots):
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.concatenate((first, [len(key)])))
        rank = rank.copy()
        rank[order[slots]] = np.repeat(slots[first], sizes)
        levels.append(rank.astype(np.int32) if n < 1 << 31 else rank)
        slots = slots[np.repeat(sizes > 1, sizes)]
        members = order[slots]
        key = rank[members] * (n + 1) + rank[members + h] + 1  # equal up to h, so members + h is at most n
        by = np.argsort(key, kind="stable")
        order[slots], key, h = members[by], key[by], h * 2
    common, a, b = np.zeros(n, np.int64), order[:-1].copy(), order[1:].copy()
    for t in range(len(levels) - 1, -1, -1):
        equal = levels[t][a] == levels[t][b]
        a[equal] += 1 << t
        b[equal] += 1 << t
    common[1:] = b - order[1:]
    return order, common


def lcp_intervals(common: np.ndarray) -> np.ndarray:
    """Rows (left, right, depth, left and right of the largest child) of all LCP intervals deeper than 0; right ends are exclusive."""
    depths, lefts, best, best_left, found = [0], [0], [0], [0], []
    for i, depth in enumerate([*common[1:].tolist(), 0], 1):
        left, size = i - 1, 1  # the child that ends here: a single suffix, or the interval closed last
        while depths[-1] > depth:
            if size > best[-1]:
                best[-1], best_left[-1] = size, left
            left = lefts.pop()
            size = best.pop()
            child = best_left.pop()
            found.append((left, i, depths.pop(), child, child + size))
            size = i - left
        if depths[-1] < depth:
            depths.append(depth)
            lefts.append(left)
            best.append(size)
            best_left.append(left)
        elif size > best[-1]:
            best[-1], best_left[-1] = size, left
    return np.array(found, np.int64).reshape(-1, 5)


def branching_tandems(codes: np.ndarray, order: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end, half) of all squares whose period breaks behind them, without repeats."""
    n, spans = len(codes), lcp_intervals(common)
    place = np.full(n + 1, -1, np.int64)
    place[order] = np.arange(n)
    symbol = np.concatenate((codes, [-1]))
    small = (spans[:, 3] - spans[:, 0]) + (spans[:, 1] - spans[:, 4])
    cuts = np.searchsorted(np.cumsum(small), np.arange(TESTS, int(small.sum()) + TESTS, TESTS)) if len(spans) else []
    found, begin = [np.zeros((0, 2), np.int64)], 0
    for end in (int(c) + 1 for c in cuts):
        some, count = spans[begin:end], small[begin:end]
        begin = min(end, len(spans))
        own = np.repeat(np.arange(len(some)), count)
        left, right, depth, child, child_end = some[own].T
        slot = left + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        slot = np.where(slot >= child, slot + child_end - child, slot)
        at = order[slot]
        ahead, behind = place[at + depth], np.where(at >= depth, place[np.maximum(at - depth, 0)], -1)
        forward = np.flatnonzero((ahead >= left) & (ahead < right))
        forward = forward[symbol[at[forward] + 2 * depth[forward]] != symbol[at[forward] + depth[forward]]]
        backward = np.flatnonzero((behind >= left) & (behind < right))
        backward = backward[symbol[at[backward] + depth[backward]] != symbol[at[backward]]]
        found += [np.column_stack((at[forward] + 2 * depth[forward], depth[forward])),
                  np.column_stack((at[backward] + depth[backward], depth[backward]))]
    pairs = np.unique(np.concatenate(found), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _rotated(codes: np.ndarray, end: int, half: int) -> int:
    """Where the stretch with period ``half`` that ends at ``end`` begins: squares are rotated left in growing steps."""
    at, step = end - 2 * half, 64
    while at > 0:
        low = max(0, at - step)
        broken = np.flatnonzero(codes[low:at] != codes[low + half:at + half])
        if len(broken):
            return low + int(broken[-1]) + 1
        at, step = low, step * 2
    return at


def periodic_stretches(codes: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal stretches with smallest period q and at least max(``least``, ``times`` * q) symbols."""
    ends, halves = branching_tandems(codes, *suffix_array(codes))
    need = np.maximum(least, times * halves)
    fits = ends >= need
    ends, halves, need = ends[fits], halves[fits], need[fits]
    for back in range(1, least + 1):  # most squares are no part of a long run, and one of the first steps tells
        at = ends - 2 * halves - back
        stays = (2 * halves + back > need) | (codes[np.maximum(at, 0)] == codes[np.maximum(at, 0) + halves])
        ends, halves, need = ends[stays], halves[stays], need[stays]
    result, known, last = [], [], -1
    for end, half, wanted in zip(ends.tolist(), halves.tolist(), need.tolist()):  # by end, then period
        if end != last:
            known, last = [], end
        if any(half % q == 0 and start <= end - 2 * half for start, q in known):
            continue  # a power of a square of the same run
        start = _rotated(codes, end, half)
        if end - start >= wanted:
            known.append((start, half))
            result.append((start, end - start, half))
    return result


def must_repeat(least: int, times: int) -> int:
    """Words that every run repeats at its period's distance."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def _suspects(x: Texts, width: int) -> np.ndarray:
    """The documents that hold ``width`` equal consecutive words twice; equal hashes alone can only add documents."""
    hashes = x.hashes()
    good = np.flatnonzero(within(x.firsts, width, len(hashes)))
    document = x.document_of_words()[good]
    keys = mix(runs(hashes, width)[good] + document.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keys)
    return np.unique(document[order[1:][keys[order[1:]] == keys[order[:-1]]]])


def _chunk_runs(texts: dict[int, list[bytes]], least: int, times: int) -> dict[int, list[tuple[int, int, int]]]:
    """The runs of each text by start, then period."""
    codes, begins, used = [], [], 0
    for words in texts.values():
        own: dict[bytes, int] = {}
        begins.append(len(codes))
        codes += [own.setdefault(w, used + len(own)) for w in words]
        used += len(own)
    names, by_text = list(texts), {}
    for start, length, period in sorted((s, n, q) for s, n, q in periodic_stretches(np.array(codes, np.int64), least, times)):
        owner = int(np.searchsorted(begins, start, "right")) - 1
        by_text.setdefault(names[owner], []).append((start - begins[owner], length, period))
    return {d: sorted(r, key=lambda x: (x[0], x[2])) for d, r in by_text.items()}


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats, that is, all but its first period."""
    gone = np.zeros(len(words), bool)
    for start, length, period in found:
        gone[start + period:start + length] = True
    return [w for w, g in zip(words, gone.tolist()) if not g]


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3, id_column: str = "doc_id", text_column: str = "text",
                  with_text: bool = False) -> DataFrame:
    """One row per input row: (doc_id, n_words, runs, top, collapsed_sha256), and collapsed_text if asked for.

    A run is a stretch of words with smallest period q, at least ``least`` and ``times`` * q words long, that no neighbouring word
    extends with period q. ``runs`` holds (start, length, period) by start, then period; ``top`` is the one with the greatest
    exact length / period (ties: smallest start, then period), null without runs. The collapsed text keeps the first period
    of each run and all words outside runs, joined by one space; the digest is SHA-256 of its UTF-8 bytes.

    Words are runs of characters other than the six ASCII blanks, of whole texts. Null, empty and blank texts have no words,
    no runs and an empty collapsed text. Repeated rows and null ids are rows like others. Other columns are ignored,
    whatever their names; an empty table gives an empty result. No shuffle; a document is judged inside one task.
    """
    if least < 1 or times < 2:
        raise ValueError("a run has at least one word and two periods")
    width = must_repeat(least, times)
    names = ["doc_id", "n_words", "runs", "top", "collapsed_sha256", *(["collapsed_text"] if with_text else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, x in chunks(batch.column("text")):
                suspects = _suspects(x, width).tolist()
                found = _chunk_runs({d: x.text_of(d).split() for d in suspects}, least, times) if suspects else {}
                every, digests, texts = [], [], []
                for d in range(len(x.counts)):
                    own, words = found.get(d, []), x.text_of(d).split()
                    text = b" ".join(collapsed(words, own) if own else words)
                    every.append([dict(zip(("start", "length", "period"), r)) for r in own])
                    digests.append(hashlib.sha256(text).hexdigest())
                    texts.append(text.decode() if with_text else None)
                tops = [min(r, key=lambda p: (-Fraction(p["length"], p["period"]), p["start"], p["period"])) if r else None for r in every]
                arrays = [batch.column("doc_id").slice(place.start, place.stop - place.start), pa.array(x.counts.astype(np.int64)),
                          pa.array(every, pa.list_(RUN)), pa.array(tops, RUN), pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string())] if with_text else arrays, names)

    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return plain.mapInArrow(run, f"doc_id bigint, n_words bigint, runs array<{RUN_SQL}>, top {RUN_SQL}, collapsed_sha256 string"
                            + (", collapsed_text string" if with_text else ""))


def with_planted_period(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text) with a period written into a tenth of the texts, by DataFrame functions: a test corpus from any corpus.

    With h the unsigned CRC-32 of the decimal id, g = floor(h / 10) and n words, a text with h % 10 = 0 and n > 0 gets, for each
    word i from a = g % n on, its own word a + (i - a) % p, where p = 1 + floor((n - a) / (3 + g % 8)). Its words are then
    joined by one space. Other texts, and those with a null id, stay as they are.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = rows.withColumns({"g": F.expr("crc32(cast(cast(doc_id as string) as binary)) div 10"), "words": F.when(h % 10 == 0, words)})
    rows = rows.withColumn("a", F.when(F.size("words") > 0, (F.col("g") % F.size("words")).cast("int")))
    rows = rows.withColumn("tail", F.size("words") - F.col("a"))
    rows = rows.withColumn("p", F.expr("cast(1 + tail div (3 + g % 8) as int)"))
    period = F.slice("words", F.col("a") + 1, F.col("p"))
    repeated = F.slice(F.flatten(F.array_repeat(period, F.expr("cast(tail div p + 1 as int)"))), F.lit(1), F.col("tail"))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), repeated), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))
