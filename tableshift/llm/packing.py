"""Mixture-controlled packing: deficit round-robin over source queues fills every window to target token proportions.

Each source that is owed at least one token in every window has a queue. In every window a queue is owed its share of
the window's tokens. What whole tokens leave over or short is its deficit (always under one token), carried to the next
window. Served in queue order, the tokens taken from the first queues up to any window are the rounded-down share of all tokens
so far, a closed form. So any task can serve any part of any queue: deficits pass between windows and partitions without a
sequential pass. All queues end together, every window but the last is full, and each token lies in one piece.

Smaller sources share one more queue, in which every document waits for the moment when its source has been served up to it: the
share of the source's tokens before it. So at any moment each of them is within a document of its own share. If even all of them
are owed less than a token a window, that queue is dealt into the largest source's in the same closed form.

Token ids are made once, in parts of the input; only counts per (source, part) are summed to place the parts in their queues.
"""

from __future__ import annotations

import re
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableshift.llm.words import LOWER
from tableshift.session import cut_lineage

_MARKS = string.punctuation.encode()
#: What may keep a word from being lower-cased and cut before it is normalised: characters from U+0300 on, which may join others or be
#: changed by NFC, and U+0130, which becomes a letter and a mark.
_NORMALISED = re.compile(rb"[\xcc-\xff]|\xc4\xb0")
#: The letters that byte-level tokenizers write for bytes: printable ones for themselves, the others from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTERS = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}
_tokenizers: dict = {}


class _Known(dict):
    """Ids of words met since the last change of generation; a missing one is made."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, word: bytes) -> bytes:
        self[word] = ids = self.make(word)
        return ids


class WordTokenizer:
    """Ids of texts by a byte-level tokenizer file that lower-cases and whose pieces never span ASCII blanks: each run of other
    characters is encoded once and remembered, in two generations of bounded size.

    In words without any of ``_NORMALISED`` the normaliser does no more than lower-case letter by letter. So letters A-Z may be
    lower-cased before it, the marks at the end, after a letter or digit, are a piece of their own, and the merges alone decide about a
    word of letters only. Other words are encoded whole by the library.
    """

    def __init__(self, path: str, most: int = 200_000):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.most, self.known, self.older = most, _Known(self._make), {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, bounds = self.encode_array(pa.array(texts, pa.string()))
        raw, bounds = ids.tobytes(), (4 * bounds).tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode_array(self, texts: pa.Array, *last: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, each followed by ``last``; where each begins and the last one ends). Nulls are empty.

        The different words of the texts are looked up once, and their ids gathered for every place.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        small = LOWER[raw]
        normalised = raw >= 0xCC
        normalised[:-1] |= (raw[:-1] == 0xC4) & (raw[1:] == 0xB0)
        for d in np.unique(np.searchsorted(bounds, np.flatnonzero(normalised), "right") - 1).tolist():
            small[bounds[d]:bounds[d + 1]] = raw[bounds[d]:bounds[d + 1]]
        split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(bounds), pa.py_buffer(small)]))
        words = split.flatten()
        real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # blanks at an end leave an empty word
        ends = np.concatenate(([0], np.cumsum(real)))[split.offsets.to_numpy()] if len(texts) else np.zeros(1, np.int64)
        coded = words.filter(pa.array(real)).dictionary_encode()
        each = list(map(self.known.__getitem__, coded.dictionary.cast(pa.large_binary()).to_pylist()))
        if len(self.known) > self.most:
            self.older, self.known = self.known, _Known(self._make)
        pool, lengths, codes = np.frombuffer(b"".join(each), "<u4"), np.array([len(x) // 4 for x in each], np.int64), coded.indices.to_numpy()
        starts, counts = (np.cumsum(lengths) - lengths)[codes], lengths[codes]
        filled = np.concatenate(([0], np.cumsum(counts)))
        own = np.diff(filled[ends])
        result_bounds = np.concatenate(([0], np.cumsum(own + len(last))))
        result = np.empty(int(result_bounds[-1]), "<u4")
        shift = np.repeat(np.arange(len(own)) * len(last), own)
        result[np.arange(len(shift)) + shift] = pool[np.arange(len(shift)) + np.repeat(starts - filled[:-1], counts)]
        for k, x in enumerate(last):
            result[result_bounds[1:] - len(last) + k] = x
        return result, result_bounds

    def _make(self, word: bytes) -> bytes:
        if word in self.older:
            return self.older[word]
        if not word.isascii() and _NORMALISED.search(word):
            return self._ask(word)
        small = word.lower()
        if small != word:
            return self.known[small]
        stem = word.rstrip(_MARKS)
        if stem and len(stem) < len(word) and (stem[-1:].isalnum() if stem[-1] < 128 else stem.decode()[-1].isalnum()):
            return self.known[stem] + self.known[word[len(stem):]]
        text = word.decode()
        if not text.isalpha():
            return self._ask(word)
        merged = self.library.model.tokenize(text if word.isascii() else text.lower().encode().decode("latin-1").translate(_LETTERS))
        return struct.pack(f"<{len(merged)}I", *[t.id for t in merged])

    def _ask(self, word: bytes) -> bytes:
        found, = self.library.encode_batch_fast([word.decode()], add_special_tokens=False)
        return struct.pack(f"<{len(found.ids)}I", *found.ids)


def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def tokenized(docs: DataFrame, path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text",
              source_column: str = "source") -> DataFrame:
    """(doc_id, source, part, at, n, ids), written to the shared folder. ``at`` counts a part's earlier tokens of the source."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"),
                       F.coalesce(F.col(source_column).cast("string"), F.lit("")).alias("source"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, filled = tokenizer(path), TaskContext.get().partitionId(), {}
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                ids, bounds = own.encode_array(some.column("text"), end_id)
                counts, at = np.diff(bounds), []
                for s, n in zip(some.column("source").to_pylist(), counts.tolist()):
                    at.append(filled.get(s, 0))
                    filled[s] = at[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("source"), pa.array([part] * len(at), pa.int32()), pa.array(at, pa.int64()), pa.array(counts),
                     pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(4 * bounds), pa.py_buffer(ids)]).cast(pa.binary())],
                    ["doc_id", "source", "part", "at", "n", "ids"])

    return cut_lineage(rows.mapInArrow(encode, f"doc_id {kind}, source string, part int, at bigint, n bigint, ids binary"))


def _placed(parts: DataFrame, *by: str) -> DataFrame:
    """(by, part, from) of written (by, part, n): the tokens in earlier parts. Summed in two steps, so that no task meets all parts."""
    parts = parts.withColumn("block", F.shiftright("part", 10))
    earlier = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    blocks = parts.groupBy(*by, "block").agg(F.sum("n").alias("block_n"))
    blocks = blocks.select(*by, "block", F.coalesce(F.sum("block_n").over(earlier(*by).orderBy("block")), F.lit(0)).alias("block_from"))
    return (parts.join(blocks, [*by, "block"])
            .select(*by, "part", (F.col("block_from") + F.coalesce(F.sum("n").over(earlier(*by, "block").orderBy("part")), F.lit(0))).alias("from")))


def _in_turn(rest: DataFrame, seed: int = 7) -> DataFrame:
    """Place documents (doc_id, source, part, at, n, ids, from, of) in one queue (doc_id, n, ids, first): a document's turn is the share
    of its source's tokens before a point in it, drawn by a hash of the source."""
    unit = F.shiftrightunsigned(F.xxhash64("source", F.lit(seed)), 11) / F.lit(float(1 << 53))
    kind = rest.schema["doc_id"].dataType.simpleString()
    order = ["turn", "source", "part", "at"]
    rows = (rest.withColumn("turn", (F.col("from") + F.col("at") + unit * F.col("n")) / F.col("of"))
            .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "n", "ids"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, filled = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            ends = filled + np.cumsum(n)
            if len(n):
                filled = int(ends[-1])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([part] * len(n), pa.int32()), pa.array(ends - n), batch.column("n"),
                                              batch.column("ids")], ["doc_id", "part", "at", "n", "ids"])

    rows = cut_lineage(rows.mapInArrow(number, f"doc_id {kind}, part int, at bigint, n bigint, ids binary"))
    one = cut_lineage(rows.groupBy("part").agg(F.sum("n").alias("n")).withColumn("all", F.lit(0)))  # one row per task
    return rows.join(cut_lineage(_placed(one, "all")), "part").select("doc_id", "n", "ids", (F.col("from") + F.col("at")).alias("first"))


class Mixture:
    """The windows of queues of given token counts, in the order they are served."""

    def __init__(self, counts: list[int], size: int):
        self.counts, self.size, self.total = counts, size, sum(counts)
        self.windows = -(-self.total // size)
        if self.total > 4 * 10**13:
            raise OverflowError("too many tokens for 64-bit window sums")
        self.ends = np.cumsum([0, *counts]).tolist()

    def before(self, window: np.ndarray, queue: int) -> np.ndarray:
        """Tokens of the queues before ``queue`` in all windows before ``window``: their share, rounded down, exactly."""
        ahead, total = self.ends[queue], max(self.total, 1)
        whole, rest = divmod(self.size * ahead, total)
        whole_high, rest_high = divmod(rest << 17, total)
        high, low = window >> 17, window & ((1 << 17) - 1)
        share = window * whole + high * whole_high + (high * rest_high + low * rest) // total
        return np.where(window >= self.windows, ahead, share)

    def taken(self, window: np.ndarray, queue: int) -> np.ndarray:
        """Tokens of the queue in all windows before ``window``."""
        return self.before(window, queue + 1) - self.before(window, queue)

    def window_of(self, token: np.ndarray, queue: int) -> np.ndarray:
        """The window of each token of the queue."""
        guess = np.maximum((token * (self.total / (self.counts[queue] * self.size))).astype(np.int64) - 2, 0)
        late = self.taken(guess, queue) > token
        while late.any():
            guess = np.where(late, np.maximum(guess - 2, 0), guess)
            late = self.taken(guess, queue) > token
        early = self.taken(guess + 1, queue) <= token
        while early.any():
            guess = np.where(early, guess + 1, guess)
            early = self.taken(guess + 1, queue) <= token
        return guess

    def pieces(self, a: np.ndarray, b: np.ndarray, queue: int) -> tuple[np.ndarray, ...]:
        """Stretches from token a to b of the queue, cut at windows: (row, begin, end, window, place in the window) of each piece."""
        w, last = self.window_of(a, queue), self.window_of(b - 1, queue)
        each = last - w + 1
        row = np.repeat(np.arange(len(a)), each)
        window = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + w[row]
        ahead, opens, closes = self.before(window, queue), self.taken(window, queue), self.taken(window + 1, queue)
        begin, end = np.maximum(opens, a[row]), np.minimum(closes, b[row])
        place = self.before(window + 1, queue) - ahead + begin - opens
        some = end > begin  # a window may owe the queue nothing
        return row[some], begin[some], end[some], window[some], place[some]


def pack(docs: DataFrame, path: str, size: int = 4096, end_id: int = 2, id_column: str = "doc_id", text_column: str = "text",
         source_column: str = "source", with_ids: bool = False) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), and the ids if asked for.

    Every document is its ids and ``end_id``; sequences hold ``size`` tokens, the last one what is left. A null or empty text is
    the end id alone; a null source counts as the empty name; repeated rows are packed one by one; other columns
    are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    tokens = tokenized(docs, path, end_id, id_column, text_column, source_column)
    kind = tokens.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    schema += ", ids binary" if with_ids else ""
    parts = cut_lineage(tokens.groupBy("source", "part").agg(F.sum("n").alias("n")))
    sizes = cut_lineage(parts.groupBy("source").agg(F.sum("n").alias("of")))
    total = sizes.agg(F.sum("of")).first()[0] or 0
    if not total:
        return spark.createDataFrame([], schema)
    # Sources that are owed a token per window: at most ``size``. With none of them the rest is the only queue.
    large = sorted(sizes.filter(F.col("of") >= -(-total // size)).collect())
    counts = [r[1] for r in large]
    rest, inner, host = total - sum(counts), None, -1
    if rest and large and rest * size < total:
        host = counts.index(max(counts))
        inner = Mixture([counts[host], rest], -(-(counts[host] + rest) // rest))
        counts[host] += rest
    elif rest:
        counts.append(rest)
    mixture, rest_queue = Mixture(counts, size), len(large)
    queues = spark.createDataFrame([(r[0], i) for i, r in enumerate(large)], "source string, queue int")
    places = cut_lineage(_placed(parts, "source").join(sizes, "source").join(F.broadcast(queues), "source", "left"))  # at most ``size`` rows

    def pieces(a: np.ndarray, b: np.ndarray, q: int) -> tuple[np.ndarray, ...]:
        if inner is None or q not in (host, rest_queue):
            return mixture.pieces(a, b, q)
        # Cut by the rest's turns in the largest queue first, then by windows.
        outer, begin, end, turn, place = inner.pieces(a, b, int(q == rest_queue))
        at = turn * inner.size + place
        row, x, y, window, place = mixture.pieces(at, at + end - begin, host)
        shift = (begin - at)[row]
        return outer[row], x + shift, y + shift, window, place

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                some = batch.slice(k, 1024)
                queue, first = some.column("queue").to_numpy(), some.column("first").to_numpy()
                n, ids = some.column("n").to_numpy(), some.column("ids")
                found = []
                for q in np.unique(queue).tolist():
                    own = np.flatnonzero(queue == q)
                    a = first[own]
                    doc, begin, end, window, place = pieces(a, a + n[own], q)
                    found.append((own[doc], begin - a[doc], end - begin, window, place))
                rows, starts, lengths, windows, offsets = map(np.concatenate, zip(*found))
                _, at, data = ids.buffers()
                begins = np.frombuffer(at, np.int32)[ids.offset:].astype(np.int64)[rows] + 4 * starts
                cuts = [memoryview(data)[a:b] for a, b in zip(begins.tolist(), (begins + 4 * lengths).tolist())]
                arrays = [some.column("doc_id").take(pa.array(rows)), pa.array(starts), pa.array(lengths),
                          pa.array([zlib.crc32(c) for c in cuts], pa.int64()), pa.array(n[rows]), pa.array(windows), pa.array(offsets)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                if with_ids:
                    arrays, names = [*arrays, pa.array([bytes(c) for c in cuts], pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    # The places are a written table: Spark broadcasts it if it is small and shuffles by (source, part) if not.
    placed = tokens.join(places, ["source", "part"])
    queued = placed.filter("queue is not null").select("doc_id", "queue", "n", "ids", (F.col("from") + F.col("at")).alias("first"))
    if rest:
        waiting = placed.filter("queue is null").drop("queue")
        queued = queued.unionByName(_in_turn(waiting).withColumn("queue", F.lit(rest_queue)))
    return queued.mapInArrow(cut, schema)


def sequences(pieces: DataFrame, size: int = 4096, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, n_tokens) from pieces with ids: each sequence whole, padded to ``size`` at its end."""
    joined = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most ``size`` pieces
    body = F.aggregate(joined, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    grouped = pieces.groupBy("sequence_id").agg(body.alias("body"), F.sum("length").alias("n_tokens"))
    pad = struct.pack("<I", pad_id) * size
    return grouped.select("sequence_id", F.substring(F.concat("body", F.lit(pad)), 1, 4 * size).alias("ids"), "n_tokens")
