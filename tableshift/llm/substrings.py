"""Passages that repeat across documents: a compressed FM-index per shard, and backward search for matching statistics.

Documents are not searched in every shard. Each window of ``window`` words has an anchor, the least hash of its ``anchor``-word
runs, and equal windows have equal anchors. Neighbouring windows with one anchor are a segment, and a segment goes to the shard of
its anchor: an index there meets all windows that could be equal, and no others have to be compared.

1. Anchors that occur in one document only are dropped; this moves anchors, not texts.
2. The segments of the others are cut from the texts. An anchor with more than ``hot`` places, or with more windows than a shard has
   room for (a text that repeats itself every few words is one segment of any length), sends its windows one by one, by
   their own hash, so that no shard gets all of a common anchor's surroundings.
3. Equal segments become one with the least document id, so copies of a passage don't fill a shard.
4. Each shard indexes its segments and streams them through the index: a window's interval gives the least document that has it.
5. Windows that a smaller document has become intervals of words to remove, per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableshift.llm.fm_index import FmIndex
from tableshift.llm.tidy import shuffles_removed
from tableshift.llm.words import chunks, runs, sliding_min, within
from tableshift.session import cut_lineage


def _segments(x, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, document, first word in the document, windows) of the segments of a chunk of texts."""
    hashes = x.hashes()
    keys = sliding_min(runs(hashes, anchor), window - anchor + 1).view(np.int64)
    good = within(x.firsts, window, len(hashes))
    if not good.any():
        none = np.zeros(0, np.int64)
        return none, none, none, none
    at = np.flatnonzero(good)
    document = x.document_of_words()[at]
    new = np.concatenate(([True], (keys[at][1:] != keys[at][:-1]) | (document[1:] != document[:-1])))
    starts = np.flatnonzero(new)
    counts = np.diff(np.concatenate((starts, [len(at)])))
    return keys[at[starts]], document[starts], at[starts] - x.firsts[document[starts]], counts


def _anchors(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(key, doc_id, text_hash, first, windows) per segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("doc_id").to_numpy(), batch.column("text_hash").to_numpy()
            for place, x in chunks(batch.column("text")):
                key, document, first, count = _segments(x, window, anchor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(ids[place][document]), pa.array(hashes[place][document]), pa.array(first.astype(np.int32)),
                     pa.array(count.astype(np.int32))], ["key", "doc_id", "text_hash", "first", "windows"])
    return docs.filter("doc_id is not null").select("doc_id", "text_hash", "text").mapInArrow(
        run, "key bigint, doc_id bigint, text_hash int, first int, windows int")


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """(route, mark, doc_id, text_hash, first, words): the wanted segments of (doc_id, text_hash, text, wanted)."""
    names = ["route", "mark", "doc_id", "text_hash", "first", "words"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def marks(words: bytes) -> tuple[int, int]:
        digest = hashlib.blake2b(words, digest_size=16).digest()
        return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            places, listed, rows = batch.column("wanted").offsets.to_pylist(), batch.column("wanted").values, []
            fields = [listed.field(c).to_numpy(zero_copy_only=False).tolist() for c in ("key", "first", "windows", "hot")]
            for d, text in enumerate(batch.column("text")):
                words = (text.as_py() or "").encode().split()
                for key, first, count, hot in zip(*(f[places[d]:places[d + 1]] for f in fields)):
                    if first + count + window - 1 > len(words):
                        continue  # another text under the same id and hash
                    if hot:
                        for at in range(first, first + count):
                            some = b" ".join(words[at:at + window])
                            mark, route = marks(some)
                            rows.append((route, mark, ids[d], hashes[d], at, some))
                            if len(rows) > 20_000:
                                yield packed(rows)
                                rows = []
                    else:
                        some = b" ".join(words[first:first + count + window - 1])
                        rows.append((key, marks(some)[0], ids[d], hashes[d], first, some))
                if len(rows) > 20_000:
                    yield packed(rows)
                    rows = []
            if rows:
                yield packed(rows)
    return texts.select("doc_id", "text_hash", "text", "wanted").mapInArrow(
        run, "route bigint, mark bigint, doc_id bigint, text_hash int, first int, words binary")


def _search(table: pa.Table, window: int) -> pa.Table:
    """One shard: the least document of every window of every segment, as one array of 64-bit ids per segment."""
    words = table.column("words").combine_chunks().cast(pa.binary())
    split = pc.split_pattern(words.cast(pa.string()), " ")
    split = split.combine_chunks() if isinstance(split, pa.ChunkedArray) else split
    coded = pc.dictionary_encode(split.flatten())
    codes = coded.indices.to_numpy().astype(np.int64) + 1
    lengths = np.diff(split.offsets.to_numpy())
    ends = np.cumsum(lengths) + np.arange(len(lengths))  # place of the 0 behind each segment
    text = np.zeros(int(lengths.sum()) + len(lengths), np.int64)
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = codes
    least = table.column("least").to_numpy()
    index = FmIndex(text, len(coded.dictionary) + 1, window)
    counts = lengths - window + 1
    segment = np.repeat(np.arange(len(lengths)), counts)
    opens = ends - lengths
    stops = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + opens[segment] + window
    matched, low, high = index.intervals(text, stops, window)
    result = least[segment]
    shared = np.flatnonzero((matched == window) & (high - low > 1))
    if len(shared):
        owner = np.cumsum(~inside) - (~inside)  # the segment of every place
        documents = least[owner[index.order]]
        spans, back = np.unique(low[shared], return_inverse=True)
        tops = np.zeros(len(spans), np.int64)
        tops[back] = high[shared]
        # Intervals of one length are apart or equal, so taking turns of (begin, end) cuts the order at them.
        cuts = np.minimum(np.column_stack((spans, tops)).ravel(), len(documents) - 1)
        lows = np.minimum.reduceat(documents, cuts)[::2]
        at_end = tops == len(documents)
        for i in np.flatnonzero(at_end):
            lows[i] = documents[spans[i]:].min()
        result[shared] = lows[back]
    return pa.table({"route": table.column("route"), "mark": table.column("mark"), "least_of": _binary(result.astype(np.int64), counts)})


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The bytes of the next ``counts`` values (rows of them) as one binary value each."""
    offsets = np.concatenate(([0], np.cumsum(counts))) * (values.nbytes // max(1, len(values)))
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values.tobytes())])


def _flat(binary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the 64-bit numbers of all values of an array without nulls, where each value's begin and the end)."""
    wide = np.int64 if pa.types.is_large_binary(binary.type) else np.int32
    _, offsets, data = binary.buffers()
    at = np.frombuffer(offsets, wide)[binary.offset:binary.offset + len(binary) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(np.int64), (at - at[0]) // 8


def _spans(met: DataFrame, window: int) -> DataFrame:
    """(doc_id, text_hash, spans): words covered by windows that a smaller document has, as pairs of 32-bit places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, firsts = batch.column("doc_id").to_numpy(), batch.column("first").to_numpy()
            least, opens = _flat(batch.column("least_of"))
            counts = np.diff(opens)
            row = np.repeat(np.arange(len(ids)), counts)
            hit = np.flatnonzero(least < ids[row])
            if not len(hit):
                continue
            # Hits that follow each other in one row are one span.
            new = np.flatnonzero(np.concatenate(([True], (np.diff(hit) > 1) | (np.diff(row[hit]) > 0))))
            last = hit[np.append(new[1:], len(hit)) - 1]
            of = row[last]
            spans = np.column_stack((hit[new], last + window)) + (firsts[of] - opens[of])[:, None]
            keep, sizes = np.unique(of, return_counts=True)
            some = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("text_hash"), _binary(spans.astype(np.int32), sizes)],
                                             ["doc_id", "text_hash", "spans"])
    return met.select("doc_id", "text_hash", "first", "least_of").mapInArrow(run, "doc_id bigint, text_hash int, spans binary")


def repeated_spans(docs: DataFrame, window: int, anchor: int, hot: int, shard_bytes: int) -> DataFrame:
    """(doc_id, text_hash, spans) of the documents that have something to remove; ``docs`` has doc_id, text_hash, text."""
    with shuffles_removed(docs.sparkSession):
        return _repeated_spans(docs, window, anchor, hot, shard_bytes)


def _repeated_spans(docs: DataFrame, window: int, anchor: int, hot: int, shard_bytes: int) -> DataFrame:
    anchors = _anchors(docs, window, anchor)
    room = shard_bytes // 8  # a window adds a word to its segment, about eight bytes
    shared = cut_lineage(anchors.groupBy("key").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"), F.count(F.lit(1)).alias("n"),
                                                    F.sum("windows").alias("windows"))
                         .filter("x < y").select("key", ((F.col("n") > hot) | (F.col("windows") > room)).alias("hot")))
    wanted = cut_lineage(anchors.join(shared, "key"))
    grouped = wanted.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("key", "first", "windows", "hot")).alias("wanted"))
    segments = cut_lineage(_cut(docs.join(grouped, ["doc_id", "text_hash"]), window))
    distinct = segments.groupBy("route", "mark").agg(F.min("doc_id").alias("least"), F.first("words").alias("words"))
    distinct = cut_lineage(distinct)
    size = distinct.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    found = cut_lineage(distinct.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)))
                        .groupBy("shard").applyInArrow(lambda table: _search(table, window), "route bigint, mark bigint, least_of binary"))
    return cut_lineage(_spans(segments.drop("words").join(found, ["route", "mark"]), window))


def remove_repeats(docs: DataFrame, window: int = 13, anchor: int = 4, id_column: str = "doc_id", text_column: str = "text",
                   hot: int = 20_000, shard_bytes: int = 8 << 20, with_text: bool = False) -> DataFrame:
    """One row per input row: (doc_id, n_words, n_removed, kept_sha256), and the kept text if asked for.

    Every word covered by a window of ``window`` consecutive words that also starts in a document with a smaller id is removed;
    windows are judged on the input. Words are runs of characters other than the six ASCII blanks; what is kept is
    joined by single spaces. The kept text is the input unchanged where nothing is removed.

    Null and empty texts have no words. Rows with a null id keep everything and remove nothing elsewhere. Rows that repeat an
    id don't count as smaller than each other. Other columns are ignored, whatever their names; an empty table
    gives an empty result.
    """
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"),
                       F.hash(F.col(text_column).cast("string")).alias("text_hash"))
    spans = repeated_spans(docs, window, anchor, hot, shard_bytes)
    per_document = spans.groupBy("doc_id", "text_hash").agg(F.collect_set("spans").alias("spans"))
    both = docs.join(per_document, ["doc_id", "text_hash"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, digests, texts = [], [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans")):
                plain = text.as_py()
                count, words = _kept(plain, spans.as_py())
                kept = b" ".join(words)
                counts.append(count)
                removed.append(count - len(words))
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append((kept.decode() if removed[-1] else plain) if with_text else None)
            arrays = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                arrays, names = [*arrays, pa.array(texts, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return both.select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + (", kept_text string" if with_text else ""))


def _kept(text: str | None, spans: list[bytes] | None) -> tuple[int, list[bytes]]:
    """(words of the text, those outside the spans)."""
    words = (text or "").encode().split()
    if not spans:
        return len(words), words
    gone = np.zeros(len(words) + 1, np.int64)
    for begin, end in np.concatenate([np.frombuffer(s, np.int32).reshape(-1, 2) for s in spans]):
        gone[min(begin, len(words))] += 1
        gone[min(end, len(words))] -= 1
    stay = (np.cumsum(gone)[:-1] == 0).tolist()
    return len(words), [w for w, s in zip(words, stay) if s]


def strip_repeats(docs: DataFrame, window: int = 50, anchor: int = 4, id_column: str = "doc_id", text_column: str = "text",
                  length_column: str | None = "n_chars", hot: int = 20_000, shard_bytes: int = 8 << 20) -> DataFrame:
    """The rows with all their columns, without the words that ``remove_repeats`` removes; ``length_column``, if there, follows.

    Texts that lose nothing stay as they are, null included; a text that loses all its words becomes empty.
    """
    fields, names = docs.schema.fields, docs.columns
    at, length_at = names.index(text_column), names.index(length_column) if length_column in names else -1
    marked = docs.toDF(*[f"c{i}" for i in range(len(names))])  # whatever the names, they can't clash
    key, text = f"c{names.index(id_column)}", f"c{at}"
    plain = marked.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"),
                          F.hash(F.col(text).cast("string")).alias("text_hash"))
    per_document = (repeated_spans(plain, window, anchor, hot, shard_bytes).groupBy("doc_id", "text_hash")
                    .agg(F.collect_set("spans").alias("spans")))
    both = (marked.withColumns({"doc_id": F.col(key).cast("bigint"), "text_hash": F.hash(F.col(text).cast("string"))})
            .join(per_document, ["doc_id", "text_hash"], "left").select(*marked.columns, "spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(len(names))]
            spans = batch.column(len(names))
            if spans.null_count < len(spans):
                texts = columns[at].to_pylist()
                lengths = columns[length_at].to_pylist() if length_at >= 0 else []
                for r in np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False)):
                    texts[r] = b" ".join(_kept(texts[r], spans[int(r)].as_py())[1]).decode()
                    if lengths:
                        lengths[r] = len(texts[r])
                columns[at] = pa.array(texts, columns[at].type)
                if lengths:
                    columns[length_at] = pa.array(lengths, columns[length_at].type)
            yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(names))])

    return both.mapInArrow(run, marked.schema).toDF(*[f.name for f in fields])
