"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of a bounded sample of labelled rows on the executors and sums them there per language; the matrix of
log-probabilities (``buckets`` x languages doubles) is broadcast; scoring gathers the matrix rows of every n-gram of a text and
sums them per document, like a sparse matrix product, in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDERS = (1, 2, 3)
MOST_LANGUAGES = 512
UNKNOWN = "und"
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F))


def _features(texts: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram order: the bucket of every n-gram (``buckets`` where it would cross into the next text), and where
    each text begins."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    ends = starts + lengths
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    for n in ORDERS:
        h = np.full(len(codes), 0x165667B1 * n & 0xFFFFFFFF, np.uint32)
        for i in range(n):
            h[:len(codes) - i] += (codes[i:] if i else codes) * _FACTORS[i]
        h ^= h >> np.uint32(15)
        h *= _FACTORS[3]
        index = (h >> shift).astype(np.int32)
        for back in range(1, n):
            at = ends - back
            index[at[at >= starts]] = buckets
        yield index, starts


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in pieces, so that few texts at a time are Python's strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _groups(texts: list[str | None], size: int = 1 << 18) -> Iterator[tuple[int, int, list[str]]]:
    """Neighbouring texts, lower-cased, of about ``size`` characters together; a longer text is alone."""
    at, some, total = 0, [], 0
    for i, t in enumerate(texts):
        t = (t or "").lower()
        if some and total + len(t) > size:
            yield at, i, some
            at, some, total = i, [], 0
        some.append(t)
        total += len(t)
    if some:
        yield at, len(texts), some


def train(labelled: DataFrame, text_column: str, label_column: str, most_rows: int = 20_000, buckets: int = 1 << 16,
          tasks: int = 24, seed: int = 7) -> tuple[list[str], np.ndarray] | None:
    """(languages, matrix of buckets + 1 rows) from about ``most_rows`` labelled rows, whole texts, evenly over the labels.

    The sample is drawn by a hash of the text, so it is the same in every run; with at most ``most_rows`` rows all are used. None without rows.
    """
    rows = labelled.select(F.col(text_column).cast("string").alias("text"), F.col(label_column).cast("string").alias("label")).dropna()
    per_label = rows.groupBy("label").count().limit(MOST_LANGUAGES + 1).collect()
    if len(per_label) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not per_label:
        return None
    share = most_rows / len(per_label)
    chances = rows.sparkSession.createDataFrame([(r[0], min(1.0, share / r[1]), r[1]) for r in per_label],
                                                "label string, chance double, n bigint")
    unit = F.shiftrightunsigned(F.xxhash64("text", F.lit(seed)), 11) / F.lit(float(1 << 53))
    # One row per language: small by construction.
    sample = rows.join(F.broadcast(chances), "label").filter(unit < F.col("chance")).select("label", "text").repartition(tasks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in _slices(batches):
            labels, texts = batch.column("label").to_pylist(), batch.column("text").to_pylist()
            for label in set(labels):
                own = [t for t, x in zip(texts, labels) if x == label]
                total = totals.setdefault(label, np.zeros(buckets + 1, np.int64))
                for _, _, some in _groups(own):
                    for index, _ in _features(some, buckets):
                        total += np.bincount(index, minlength=buckets + 1)
        for label, total in totals.items():
            yield pa.RecordBatch.from_pydict({"label": [label], "counts": [total.tobytes()]})

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b.as_py(), np.int64) for b in table.column("counts"))
        return pa.table({"label": table.column("label")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "label string, counts binary"
    summed = {r[0]: np.frombuffer(r[1], np.int64) for r in sample.mapInArrow(count, schema).groupBy("label").applyInArrow(add, schema).collect()}
    languages = sorted(summed)
    if not languages:
        return None
    counts = np.stack([summed[x][:buckets] for x in languages], axis=1) + 0.5
    matrix = np.zeros((buckets + 1, len(languages)))
    matrix[:buckets] = np.log(counts / counts.sum(axis=0))
    return languages, matrix


def score(texts: list[str | None], languages: list[str], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the best language, its posterior probability) of each text, equal priors; ties go to the first language."""
    best, sure = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    buckets = len(matrix) - 1
    for a, b, some in _groups(texts):
        total = np.zeros((b - a, len(languages)))
        filled = np.fromiter((bool(t) for t in some), bool, len(some))
        if filled.any():
            for index, starts in _features(some, buckets):
                total[filled] += np.add.reduceat(matrix[index], starts[filled], axis=0)
        top = total.argmax(axis=1)
        best[a:b] = top
        sure[a:b] = 1 / np.exp(total - total[np.arange(b - a), top][:, None]).sum(axis=1)
    return best, sure


def has_letter(text: Column) -> Column:
    return F.coalesce(text.cast("string").rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray] | None, id_column: str = "doc_id",
             text_column: str = "text") -> DataFrame:
    """One row per input row: (doc_id, lang_pred, score), from the whole text only.

    ``und`` with score 0 where the text is null or has no letter, or where there is no model. Repeated rows, and texts that
    are equal, get equal results; other columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"),
                       has_letter(F.col(text_column)).alias("letter"))
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)  # buckets x languages, both bounded

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, matrix = shared.value
        names = np.array([*languages, UNKNOWN], object)
        for batch in _slices(batches):
            letters = batch.column("letter").to_numpy(zero_copy_only=False).astype(bool)
            best, sure = score(batch.column("text").to_pylist(), languages, matrix)
            best[~letters], sure[~letters] = len(languages), 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names[best], pa.string()), pa.array(sure)], ["doc_id", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")


def held_out(id_column: Column) -> Column:
    """Rows kept out of training: crc32 of the id as text is a multiple of 5. A null id is held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def keep_identified(docs: DataFrame, model: tuple[list[str], np.ndarray] | None, text_column: str = "text", least: float = 0.5,
                    enough: int = 20) -> DataFrame:
    """The rows, with all their columns, whose text has a letter and, among the learnt languages, one of at least ``least`` probability.

    Texts of fewer than ``enough`` characters say too little to go for their probability. Text in a language that was not learnt
    usually stays: the probability is shared among the learnt ones alone. Without a model every row with a letter stays.
    """
    if model is None:
        return docs.filter(has_letter(F.col(text_column)))
    names = docs.columns
    marked = docs.toDF(*[f"c{i}" for i in range(len(names))])  # whatever the names, they can't clash
    text = f"c{names.index(text_column)}"
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages, both bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, matrix = shared.value
        for batch in _slices(batches):
            texts = batch.column(text).cast(pa.string()).to_pylist()
            _, sure = score(texts, languages, matrix)
            yield batch.filter(pa.array((sure >= least) | (np.fromiter(map(len, texts), np.int64, len(texts)) < enough)))

    return marked.filter(has_letter(F.col(text))).mapInArrow(run, marked.schema).toDF(*names)
