"""Exact phrases and words in proximity, from a distributed positional inverted index.

1. *Index.* Documents are taken in segments of whole documents. A segment is one row: its documents, the terms it has, and for each
   term the list of places where it occurs, counted through the segment. The index is a written table and can serve
   many searches. A search for known items keeps the lists of their terms only: a bitmap of term checksums, of fixed size,
   leaves out most others; a false hit costs an unused list.
2. *Items* are cut into windows of consecutive words. Equal windows of all items are one.
3. The index gives the frequency of every term. A window's terms are ordered by it, and a window goes to the segments that
   have its rarest term.
4. In a segment the places of the rarest term, moved back by its offset in the window, are the candidates. The lists of the next rarest terms,
   moved by theirs, are intersected one after the other; most candidates end at the second list. What is left after the last one
   is an exact match: lists are compared by whole terms, not by hashes.

Many windows for one segment are searched in blocks, each a task of its own, so memory is bounded by a segment and a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableshift.session import counted_step, cut_lineage

#: Text per segment, in bytes.
SEGMENT = 4 << 20
#: Bits of the map of term checksums, 256 KB.
MAP_BITS = 1 << 21
#: Windows searched together in one segment, and candidates intersected at a time.
BLOCK, CANDIDATES = 1 << 16, 1 << 20
# Bytes of words: digits, lower-cased letters, and everything outside ASCII. All others part words.
FOLD = np.full(256, 32, np.uint8)
FOLD[48:58], FOLD[65:91], FOLD[97:123], FOLD[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(97, 123), np.arange(128, 256)


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the words of all texts, number of words of each); nulls have none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    folded = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(bounds - bounds[0]), pa.py_buffer(FOLD[raw])])
    split = pc.ascii_split_whitespace(folded)
    values = split.flatten()
    real = pc.binary_length(values).to_numpy(zero_copy_only=False) > 0  # blanks at an end leave an empty word
    ends = np.concatenate(([0], np.cumsum(real)))[split.offsets.to_numpy() - split.offsets[0].as_py()] if len(texts) else np.zeros(1, np.int64)
    return values.filter(pa.array(real)), np.diff(ends)


def _parts(texts: pa.Array, size: int) -> Iterator[slice]:
    """Consecutive whole texts of about ``size`` bytes; a longer one is a part of its own."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield slice(at, end)
        at = end


def checksum_map(terms: DataFrame, bits: int = MAP_BITS) -> bytes:
    """One bit per CRC-32 (modulo ``bits``) of the column ``term``; the driver gets at most ``bits`` / 32 numbers."""
    at = (F.crc32(F.col("term").cast("binary")) % bits).cast("int")
    words = terms.select(at.alias("at")).groupBy(F.shiftright("at", 5).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("at").bitwiseAND(31))).alias("set"))
    found = np.zeros(bits // 32, np.int32)
    for word, value in words.collect():
        found[word] = value
    return found.tobytes()


def positional_index(docs: DataFrame, terms: DataFrame | None = None, segment_bytes: int = SEGMENT) -> DataFrame:
    """(segment, doc_ids, n_words, terms, counts, places) of the columns doc_id and text, written to the shared folder.

    ``places`` holds the places of each term one after the other, as 32-bit numbers through the segment's words in order.
    With ``terms`` (term), lists of most other terms are left out; the words are counted and placed all the same.
    """
    spark = docs.sparkSession
    kept = spark.sparkContext.broadcast(checksum_map(terms)) if terms is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        wanted = np.unpackbits(np.frombuffer(kept.value, np.uint8), bitorder="little").astype(bool) if kept else None
        for batch in batches:
            texts = batch.column("text")
            for part in _parts(texts, segment_bytes):
                words, counts = tokens(texts[part])
                coded = words.dictionary_encode()
                names, codes = coded.dictionary, coded.indices.to_numpy()
                places = np.arange(len(codes), dtype=np.int32)
                if wanted is not None:
                    sums = np.fromiter((crc32(t) for t in names.cast(pa.large_binary()).to_pylist()), np.int64, len(names))
                    places = places[wanted[sums % len(wanted)][codes]]
                order = places[np.argsort(codes[places], kind="stable")]
                each = np.bincount(codes[places], minlength=len(names))
                there = np.flatnonzero(each)
                lists = [batch.column("doc_id")[part].to_pylist(), counts.tolist(), names.take(pa.array(there)).to_pylist(), each[there].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array(lists[:1], pa.list_(pa.int64())), pa.array(lists[1:2], pa.list_(pa.int32())),
                     pa.array(lists[2:3], pa.list_(pa.string())), pa.array(lists[3:], pa.list_(pa.int32())),
                     pa.array([order.tobytes()], pa.binary())], ["segment", "doc_ids", "n_words", "terms", "counts", "places"])
                number += 1

    return cut_lineage(docs.select("doc_id", "text").mapInArrow(
        run, "segment bigint, doc_ids array<bigint>, n_words array<int>, terms array<string>, counts array<int>, places binary"))


def item_windows(items: DataFrame, width: int) -> tuple[DataFrame, DataFrame, int]:
    """((window, terms) of all different windows, (window, item_id), number of windows) of the columns item_id and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch.column("text"), 1 << 16):
                words, counts = tokens(batch.column("text")[part])
                starts = np.cumsum(counts) - counts
                rows = [(i, int(a), min(width, int(n))) for i, a, n in zip(batch.column("item_id")[part].to_pylist(), starts, counts)
                        for a in range(a, a + max(1, n - width + 1)) if n]
                flat = np.concatenate([np.arange(a, a + n) for _, a, n in rows]) if rows else np.zeros(0, np.int64)
                ends = np.cumsum([0, *(n for _, _, n in rows)]).astype(np.int32)
                taken = words.take(pa.array(flat)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), taken)],
                                                 ["item_id", "terms"])

    rows = cut_lineage(items.filter("item_id is not null").select("item_id", "text").mapInArrow(
        run, "item_id bigint, terms array<string>").distinct())
    # Numbers are fixed by being written.
    windows, count = counted_step(rows.select("terms").distinct().withColumn("window", F.monotonically_increasing_id()))
    return windows, cut_lineage(rows.join(windows, "terms").select("window", "item_id")), count


class Postings:
    """The lists of one segment."""

    def __init__(self, row: dict):
        self.terms = pa.array(row["terms"], pa.string())
        self.counts = np.array(row["counts"], np.int64)
        self.firsts = np.cumsum(self.counts) - self.counts
        self.places = np.frombuffer(row["places"], np.int32).astype(np.int64)
        self.ends = np.cumsum(np.array(row["n_words"], np.int64))  # of the documents
        self.span = int(self.ends[-1]) + 1 if len(self.ends) else 1
        self.keys = np.repeat(np.arange(len(self.counts)), self.counts) * self.span + self.places

    def of(self, code: int) -> np.ndarray:
        return self.places[self.firsts[code]:self.firsts[code] + self.counts[code]]

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, "right")

    def have(self, codes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether each term occurs at each place."""
        wanted = codes * self.span + places
        at = np.searchsorted(self.keys, wanted)
        return self.keys[np.minimum(at, len(self.keys) - 1)] == wanted


class Windows:
    """The windows to search for, each with its terms from the rarest on."""

    def __init__(self, numbers: np.ndarray, order: pa.ListArray, terms: pa.Array):
        flat = order.flatten()
        codes = pc.index_in(flat.field("term"), value_set=terms).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = pc.list_value_length(order).to_numpy(zero_copy_only=False).astype(np.int64)
        firsts = np.cumsum(lengths) - lengths
        whole = np.minimum.reduceat(codes, firsts) >= 0 if len(firsts) else np.zeros(0, bool)  # every term is in the segment
        self.numbers, self.firsts, self.lengths = numbers[whole], firsts[whole], lengths[whole]
        self.codes, self.offsets = codes, flat.field("offset").to_numpy(zero_copy_only=False).astype(np.int64)


def exact_phrases(lists: Postings, w: Windows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window, first place, length) of all occurrences of the windows' words in order, inside one document."""
    rarest = w.codes[w.firsts]
    load = np.cumsum(lists.counts[rarest])
    begin = 0
    while begin < len(w.firsts):
        end = max(begin + 1, int(np.searchsorted(load, (load[begin - 1] if begin else 0) + CANDIDATES, "right")))
        counts = lists.counts[rarest[begin:end]]
        own = np.repeat(np.arange(begin, end), counts)
        nth = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = lists.places[lists.firsts[rarest[own]] + nth] - w.offsets[w.firsts[own]]
        fits = start >= 0
        own, start = own[fits], start[fits]
        document = lists.document(start)
        fits = (document < len(lists.ends)) & (start + w.lengths[own] <= lists.ends[np.minimum(document, len(lists.ends) - 1)])
        own, start = own[fits], start[fits]
        for r in range(1, int(w.lengths[begin:end].max())):
            if not len(own):
                break
            at = w.firsts[own] + np.minimum(r, w.lengths[own] - 1)
            stays = lists.have(w.codes[at], start + w.offsets[at])
            own, start = own[stays], start[stays]
        yield w.numbers[own], start, w.lengths[own]
        begin = end


def near_words(lists: Postings, w: Windows, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window, first place, length) of the least stretches that hold every different word of a window, in any order.

    A stretch is in one document, at most ``slop`` words longer than the window, and no part of it holds them all.
    """
    for i, first in enumerate(w.firsts.tolist()):
        codes = list(dict.fromkeys(w.codes[first:first + w.lengths[i]].tolist()))  # from the rarest on
        most = int(w.lengths[i]) + slop
        rarest, near = lists.of(codes[0]), []
        for code in codes:
            places = lists.of(code)
            after = np.searchsorted(rarest, places)
            before = rarest[np.maximum(after - 1, 0)]
            places = places[(np.abs(places - before) < most) | (np.abs(rarest[np.minimum(after, len(rarest) - 1)] - places) < most)]
            near.append(places)
            if not len(places):
                break
        if not len(near[-1]):
            continue
        start = np.sort(np.concatenate(near))
        last, never = start.copy(), np.iinfo(np.int64).max // 2
        follow = np.zeros((len(near), len(start)), np.int64)
        for k, places in enumerate(near):
            padded = np.append(places, never)
            last = np.maximum(last, padded[np.searchsorted(places, start)])
            follow[k] = padded[np.searchsorted(places, start, "right")]
        least = np.max(np.minimum(follow, never), axis=0, initial=0) > last  # without its first word a word is missing
        good = least & (last - start < most)
        start, last = start[good], last[good]
        same = lists.document(start) == lists.document(last)
        start, last = start[same], last[same]
        yield np.full(len(start), w.numbers[i]), start, last - start + 1


MATCH = pa.struct([("window", pa.int64()), ("start", pa.int32()), ("length", pa.int32())])


def _cell(segment: pa.Table, windows: pa.Table, slop: int | None) -> pa.Table:
    """One segment and one block of windows: the matches of each document."""
    names = ["segment", "ordinal", "matches"]
    if not len(segment) or not len(windows):
        return pa.table({"segment": pa.array([], pa.int64()), "ordinal": pa.array([], pa.int32()), "matches": pa.array([], pa.list_(MATCH))})
    row = segment.select(["n_words", "terms", "counts", "places"]).to_pylist()[0]
    lists = Postings(row)
    w = Windows(windows.column("window").to_numpy(), pa.concat_arrays(windows.column("order").chunks), lists.terms)
    found = list(exact_phrases(lists, w) if slop is None else near_words(lists, w, slop)) or [(np.zeros(0, np.int64),) * 3]
    number, start, length = (np.concatenate(c) for c in zip(*found))
    document = lists.document(start)
    order = np.lexsort((number, start, document))
    number, start, length, document = number[order], start[order], length[order], document[order]
    start = start - np.concatenate(([0], lists.ends))[document]
    owners, firsts = np.unique(document, return_index=True)
    matches = pa.StructArray.from_arrays([pa.array(number), pa.array(start.astype(np.int32)), pa.array(length.astype(np.int32))], fields=list(MATCH))
    bounds = np.append(firsts, len(document)).astype(np.int32)
    return pa.table([pa.array([segment.column("segment")[0].as_py()] * len(owners), pa.int64()), pa.array(owners.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(bounds), matches)], names)


def search(index: DataFrame, windows: DataFrame, count: int, slop: int | None = None, block: int = BLOCK) -> DataFrame:
    """(segment, ordinal, matches) for the documents with a match, at most one row per document and block of windows, written.

    ``matches`` are (window, start, length), in the document's words from 0; without ``slop`` they are exact phrases.
    """
    directory = index.select("segment", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("segment", "t.terms", "t.counts").toDF(
        "segment", "term", "n")
    frequency = directory.groupBy("term").agg(F.sum("n").alias("n"))
    placed = windows.select("window", F.posexplode("terms").alias("offset", "term")).join(frequency, "term", "left")
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term")))
    ordered = cut_lineage(placed.groupBy("window").agg(order.alias("order")).filter(F.col("order")[0]["n"] > 0))
    blocks = max(1, -(-count // block))
    met = ordered.withColumns({"term": F.col("order")[0]["term"], "part": F.pmod(F.xxhash64("window"), F.lit(blocks)).cast("int")}).join(
        directory.select("segment", "term"), "term").select("segment", "part", "window", F.transform(
            "order", lambda t: F.struct(t["offset"].alias("offset"), t["term"].alias("term"))).alias("order"))
    met = cut_lineage(met)
    keys = ["segment", "part"]
    lists = index.select("segment", "n_words", "terms", "counts", "places", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("part"))
    lists = lists.join(met.select(*keys).distinct(), keys, "left_semi")
    return cut_lineage(lists.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(
        lambda a, b: _cell(a, b, slop), "segment bigint, ordinal int, matches array<struct<window:bigint, start:int, length:int>>"))


def _named(docs: DataFrame, items: DataFrame, id_column: str, item_column: str, text_column: str) -> tuple[DataFrame, DataFrame]:
    return (docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text")),
            items.select(F.col(item_column).cast("bigint").alias("item_id"), F.col(text_column).cast("string").alias("text")))


def _found(docs: DataFrame, items: DataFrame, width: int, slop: int | None, segment_bytes: int, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(index, matches per document, owners of windows)."""
    windows, owners, count = item_windows(items, width)
    index = positional_index(docs, windows.select(F.explode("terms").alias("term")).distinct(), segment_bytes)
    return index, search(index, windows, count, slop, block), owners


def phrase_matches(docs: DataFrame, items: DataFrame, width: int = 10, slop: int | None = None, id_column: str = "doc_id",
                   item_column: str = "item_id", text_column: str = "text", segment_bytes: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, start, length): every stretch of a document's words that matches a window of an item.

    A window is ``width`` consecutive words of an item; an item of fewer words, but not none, is one window. Without ``slop`` a match is the
    window's words in order. With it, a match is a least stretch that holds every different word of the window in any order
    and is at most ``slop`` words longer than the window. Nulls, repeated rows and other columns are treated as in ``contamination``.
    """
    docs, items = _named(docs, items, id_column, item_column, text_column)
    index, found, owners = _found(docs, items, width, slop, segment_bytes, block)
    ids = index.select("segment", F.posexplode("doc_ids").alias("ordinal", "doc_id"))
    return found.join(ids, ["segment", "ordinal"]).select("segment", "ordinal", "doc_id", F.explode("matches").alias("m")).join(
        owners.withColumnRenamed("window", "number"), F.col("m.window") == F.col("number")).select(
        "segment", "ordinal", "doc_id", "item_id", "m.start", "m.length").distinct().drop("segment", "ordinal")


def contamination(docs: DataFrame, items: DataFrame, width: int = 10, id_column: str = "doc_id", item_column: str = "item_id",
                  text_column: str = "text", segment_bytes: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """One row per document: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated).

    Words are runs of digits, letters A-Z (lower-cased) and characters outside ASCII, of whole texts. A window is ``width`` consecutive words of
    an item; an item of fewer words, but not none, is one window. A document's word is hit inside any occurrence of a window;
    ``n_items`` counts the items with windows that occur, and ``items_sha256`` is the SHA-256 of their ids, sorted as strings and
    joined by commas.

    Null, empty and wordless texts have no words. Items without an id take no part, and rows that repeat an item's id are one item with
    the windows of all. Documents that repeat an id, or have none, are rows of their own. Other columns are ignored, whatever
    their names; without documents the result is empty, without items nothing is hit.
    """
    docs, items = _named(docs, items, id_column, item_column, text_column)
    index, found, owners = _found(docs, items, width, None, segment_bytes, block)
    keys = ["segment", "ordinal"]
    every = F.array_sort(F.flatten(F.collect_list(F.transform("matches", lambda m: F.struct(m["start"].alias("b"), (m["start"] + m["length"]).alias("e"))))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("e"))
    covered = F.aggregate(every, start, lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["e"] - F.greatest(a["e"], s["b"]))).alias("n"), F.greatest(a["e"], s["e"]).alias("e")), lambda a: a["n"])
    hit = found.groupBy(*keys).agg(covered.alias("n_hit"))
    named = found.select(*keys, F.explode(F.array_distinct("matches.window")).alias("window")).join(owners, "window").select(
        *keys, F.col("item_id").cast("string").alias("item")).distinct()
    listed = named.groupBy(*keys).agg(F.array_sort(F.collect_list("item")).alias("items"))
    every_document = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("ordinal", "d")).select(
        *keys, "d.doc_ids", "d.n_words")
    both = every_document.join(hit.join(listed, keys), keys, "left")
    return both.select(F.col("doc_ids").alias("doc_id"), F.col("n_words").cast("bigint").alias("n_words"),
                       F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                       F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
                       F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
                       (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
