"""Exact duplicates by progressive refinement: by length, then by a hash of the prefix, then by a hash of the whole text.

Lengths and prefix hashes are narrow rows. The texts themselves are never shuffled: where a blocked Bloom filter of the surviving
(length, prefix) groups says that a row may be in one, the scan hashes its whole text. Grouping by that hash is exact, so
rows that passed the filter wrongly end up alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableshift.llm.bloom import blocked_bloom, may_contain
from tableshift.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def folded(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else changed; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", prefix: int = 64,
                     filter_blocks: int = 1 << 16, digest_all: bool = False) -> DataFrame:
    """One row per input row: (doc_id, keep_id, group_size, kept, text_sha256).

    Of equal texts the row with the largest id stays; ``group_size`` counts the rows. ``text_sha256`` is the digest of the
    folded text, null for rows that no other row resembles unless ``digest_all``.

    Null and empty texts are equal. A null id is smaller than any other: such a row stays only if all ids of its group are null.
    Rows that repeat an id and a text carry the same values, kept included. Other columns are ignored, whatever
    their names. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), folded(F.col(text_column)).alias("t"))
    narrow = cut_lineage(rows.select("doc_id", F.octet_length("t").alias("length"),
                                     F.xxhash64(F.octet_length("t"), F.substring("t", 1, prefix)).alias("prefix")))
    lengths = narrow.groupBy("length").count().filter("count > 1").select("length")
    groups = narrow.join(lengths, "length").groupBy("prefix").count().filter("count > 1").select("prefix")
    bloom = blocked_bloom(groups, "prefix", filter_blocks)
    keyed = rows.withColumn("prefix", F.xxhash64(F.octet_length("t"), F.substring("t", 1, prefix)))
    whole = F.sha2(F.col("t"), 256)
    hashed = may_contain(keyed, "prefix", bloom, filter_blocks, "resembled").select(
        "doc_id", "resembled", (whole if digest_all else F.when(F.col("resembled"), whole)).alias("text_sha256"))
    hashed = cut_lineage(hashed)
    equal = (hashed.filter("resembled").groupBy("text_sha256")
             .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    # Written, so that the join's sides are plain scans and a hot group's rows can be split over tasks.
    equal = cut_lineage(equal.filter("group_size > 1"))
    together = hashed.filter("resembled").join(equal, "text_sha256", "left")
    single = hashed.filter("not resembled").withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("bigint")})
    both = together.unionByName(single).withColumns({
        "keep_id": F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")),
        "group_size": F.coalesce("group_size", F.lit(1).cast("bigint"))})
    return both.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                       "text_sha256")
