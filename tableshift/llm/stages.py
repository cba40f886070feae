"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and works on all documents it is given."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableshift.llm import langid
from tableshift.llm.bloom import blocked_bloom, may_contain
from tableshift.llm.exact_dedup import exact_duplicates
from tableshift.llm.neardup import near_duplicates
from tableshift.llm.packing import pack
from tableshift.llm.substrings import strip_repeats
from tableshift.llm.tidy import batches_of_texts
from tableshift.session import cut_lineage


def row_mark() -> Column:
    """A digest of a row's id and text. Null counts as the empty text, and as an id of its own."""
    return F.md5(F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.col("text"), F.lit(""))))


def _marked(docs: DataFrame, key: Column, wanted: DataFrame, filter_blocks: int) -> tuple[DataFrame, DataFrame]:
    """(rows certainly without their ``key`` in ``wanted`` (key, ...), the others with the columns of ``wanted``, null where it has none).

    Columns are named c0, c1 and so on, so that none can clash. A blocked Bloom filter passes most texts by the join.
    """
    columns = docs.select("*", key.alias("key")).toDF(*[f"c{i}" for i in range(len(docs.columns))], "key")
    tested = may_contain(columns, "key", blocked_bloom(wanted, "key", filter_blocks), filter_blocks)
    return tested.filter("not bloom_hit").drop("bloom_hit", "key"), tested.filter("bloom_hit").drop("bloom_hit").join(wanted, "key", "left")


def without(docs: DataFrame, key: Column, dropped: DataFrame, filter_blocks: int = 1 << 16) -> DataFrame:
    """The rows whose ``key`` is not among ``dropped`` (key), with all their columns; rows with a null key stay."""
    gone = cut_lineage(dropped.dropna().distinct().withColumn("gone", F.lit(True)))
    stay, others = _marked(docs, key, gone, filter_blocks)
    return stay.unionByName(others.filter("gone is null").drop("gone", "key")).toDF(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those of 20 characters or more for which no language that the labels teach has half the probability."""
    batches_of_texts(spark)
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))), "text", "lang")
    return langid.keep_identified(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str, filter_blocks: int = 1 << 16) -> DataFrame:
    """Of texts that are equal but for the case of A-Z one row stays, with the largest id.

    Rows are told apart by id and text, so an id's other texts are judged for themselves. Of rows that repeat both, the one whose
    other columns come first as JSON stays; where one id has the text in several cases, one of them.
    """
    rows = docs.select(F.struct("doc_id", row_mark().alias("key")).alias("doc_id"), "text")
    decided = exact_duplicates(rows).filter("group_size > 1").select("doc_id.key", "kept")
    touched = cut_lineage(decided.groupBy("key").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n")).filter("not stays or n > 1")
                          .drop("n"))
    stay, others = _marked(docs, row_mark(), touched, filter_blocks)
    result = stay.unionByName(others.filter("stays is null").drop("stays", "key"))
    if not touched.filter("stays").isEmpty():
        # The texts of a repeated row are equal or empty; combined inside tasks first, however often it is repeated.
        row = F.struct(*stay.columns)
        one = others.filter("stays").groupBy("key").agg(F.min_by(row, F.to_json(row)).alias("one"))
        result = result.unionByName(one.select("one.*"))
    return result.toDF(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str, filter_blocks: int = 1 << 16) -> DataFrame:
    """Of each group of documents linked at a similarity of 0.8 the one with the smallest id stays.

    Rows whose id is null or occurs more than once are told apart by id and text, and come after all others, in the order of a hash.
    """
    batches_of_texts(spark)
    odd = cut_lineage(docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
                      .select(F.col("doc_id").alias("key"), F.lit(True).alias("odd")))
    if odd.isEmpty():
        return without(docs, F.col("doc_id"), near_duplicates(docs, percent=80).filter("not kept").select(F.col("doc_id").alias("key")))
    names = docs.columns
    row_id, text = f"c{names.index('doc_id')}", f"c{names.index('text')}"
    stay, others = _marked(docs, F.col("doc_id"), odd, filter_blocks)
    every = stay.withColumn("odd", F.col(row_id).isNull()).unionByName(others.withColumn("odd", F.coalesce("odd", F.lit(False))).drop("key"))
    late = F.xxhash64(row_id, text).bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(1 << 62)
    every = cut_lineage(every.withColumn("own", F.when(F.col("odd"), late).otherwise(F.col(row_id).cast("bigint"))).drop("odd"))
    dropped = near_duplicates(every, percent=80, id_column="own", text_column=text).filter("not kept").select(F.col("doc_id").alias("key"))
    return without(every, F.col("own"), dropped).drop("own").toDF(*names)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages of 50 words or more that a document with a smaller id has go."""
    batches_of_texts(spark)
    return strip_repeats(docs, window=50)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, mixed like the whole."""
    batches_of_texts(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language), ("exact_dedup", exact), ("minhash_near_dedup", near), ("substring_dedup", passages),
          ("packing", packed)]
