"""The registered queries of this subpackage: each operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableshift.llm import langid
from tableshift.llm.bpe import encode_documents
from tableshift.llm.embeddings import near_vectors
from tableshift.llm.exact_dedup import exact_duplicates
from tableshift.llm.neardup import near_duplicates
from tableshift.llm.negatives import hard_negatives
from tableshift.llm.packing import pack
from tableshift.llm.periodic import periodic_runs, with_planted_period
from tableshift.llm.phrases import contamination
from tableshift.llm.shard import shard_by_size
from tableshift.llm.substrings import remove_repeats
from tableshift.llm.urls import judge_urls
from tableshift.llm.warc import archive_round_trip

#: (action, host, path) of the contract's rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to packaged WARC archives and read back by range."""
    return archive_round_trip(spark, read(spark, sf_dir, "pages"))


OP1_SQL = """
with p as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as hex from pages),
g as (select hex, max(page_id) as first from p group by all),
q as (select hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, 5 * i + 1, 5))::int >> (15 - 5 * j)) & 31) + 1, 1), '' order by i, j) as payload_digest
    from (select distinct hex from p), range(8) a(i), range(4) b(j) group by hex)
select page_id, strlen(body)::bigint as payload_bytes, payload_digest,
    case when page_id = first then 'response' else 'revisit' end as record_type,
    case when page_id <> first then first end as refers_to
from p join g using (hex) join q using (hex)
"""


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 13 words that a document with a smaller id has."""
    return remove_repeats(read(spark, sf_dir, "documents"))


OP2_SQL = r"""
with w as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
p as (select doc_id, unnest(range(1, len(words) - 11)) as pos, words from w where len(words) >= 13),
g as (select doc_id, pos, array_to_string(words[pos:pos + 12], ' ') as passage from p),
f as (select passage, min(doc_id) as least from g group by all),
h as (select doc_id, pos from g join f using (passage) where least < doc_id),
r as (select distinct doc_id, pos + i as pos from h, range(13) t(i)),
d as (select doc_id, list(pos) as gone from r group by all),
k as (select doc_id, words, list_filter(words, lambda x, i: not list_contains(coalesce(gone, []), i)) as kept
    from w left join d using (doc_id))
select doc_id, len(words)::bigint as n_words, (len(words) - len(kept))::bigint as n_removed,
    sha256(coalesce(array_to_string(kept, ' '), '')) as kept_sha256 from k
"""


def op3_shard_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    placed = shard_by_size(read(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts of all documents, apart from the case of A-Z."""
    return exact_duplicates(read(spark, sf_dir, "documents"), digest_all=True)


OP4_SQL = """
with n as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from n group by all)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from n join g using (text_sha256)
"""


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the public ranks and decoded again."""
    return encode_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose sets of five-word shingles are 0.85 similar, and their components."""
    return near_duplicates(read(spark, sf_dir, "documents"), percent=85)


OP6_SQL = r"""
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
s as (select doc_id, case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) end as set from w),
e as (select doc_id, unnest(set) as shingle from s), n as (select doc_id, len(set) as n from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as shared from e a join e b using (shingle) where a.doc_id <> b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 85 * (x.n + y.n - shared)),
r(a, b) as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
c as (select a, min(b) as least from r group by a)
select doc_id, n as n_shingles, least(doc_id, coalesce(least, doc_id)) as component_id,
    doc_id = least(doc_id, coalesce(least, doc_id)) as kept from n left join c on doc_id = a
"""


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's URL."""
    rules = spark.createDataFrame(list(RULES), "action string, host string, path string")
    return judge_urls(read(spark, sf_dir, "pages"), rules)


OP7_SQL = """
with p as (select page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') as path from pages),
r(action, rule_host, rule_path) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m as (select page_id, host, path, rule_host || rule_path as rule, action,
    row_number() over (partition by page_id order by length(rule_host || rule_path) desc nulls last) as place
    from p left join r on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select page_id, host, path, rule, coalesce(action, 'allow') as verdict from m where place = 1
"""

def op8_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens, each mixed like the whole."""
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with a cosine of at least 0.93 under one label, and their components."""
    return near_vectors(read(spark, sf_dir, "embeddings"))


OP9_SQL = """
with recursive v as (select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
    and list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, b) as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
n as (select a, count(*) as n_links from l group by a), c as (select a, min(b) as least from r group by a)
select vec_id, coalesce(n_links, 0) as n_links, least(vec_id, coalesce(least, vec_id)) as component_id,
    vec_id = least(vec_id, coalesce(least, vec_id)) as kept
from embeddings left join n on vec_id = n.a left join c on vec_id = c.a
"""


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the documents that are not held out."""
    docs = read(spark, sf_dir, "documents")
    known = docs.withColumn("out", langid.held_out(F.col("doc_id")))
    model = langid.train(known.filter("not out"), "text", "lang")
    # The remainder is the id's own, so it goes with the row instead of a join.
    return langid.identify(docs, model).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, after a period is written into a tenth of them; digests of all runs and of what is left."""
    found = periodic_runs(with_planted_period(read(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "top.start", "top.length", "top.period",
                        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
                        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), "collapsed_sha256")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score 30 to 90 percent of each positive of every hundredth vector; every seventh label is shifted first."""
    vectors = read(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


OP12_SQL = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same, list_inner_product(a.e, b.e)::bigint as score
    from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, other as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, other) <= 5),
n as (select anchor_id, positive_id, positive_score, other as negative_id, score as negative_score,
    row_number() over (partition by anchor_id, positive_id order by score desc, other)::int as rank
    from p join s using (anchor_id) where not same and 100 * score between 30 * positive_score and 90 * positive_score)
select * from n where rank <= 10
"""

def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside occurrences of ten consecutive words of a benchmark item, and the items."""
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_WORDS_SQL = r"""list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w"""
OP13_SQL = f"""
with d as (select doc_id, {_WORDS_SQL} from documents), b as (select item_id, {_WORDS_SQL} from benchmark where item_id is not null),
p as (select item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) as i from b where len(w) > 0),
v as (select distinct item_id, w[i:i + 9] as words from p), n as (select distinct len(words) as n from v),
q as (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, n where len(w) >= n),
h as (select doc_id, i, n, item_id from (select doc_id, i, n, w[i:i + n - 1] as words from q) join v using (words)),
c as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + n)) as place from h) group by doc_id),
m as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items
    from h group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (doc_id) left join m using (doc_id)
"""

QUERIES = {f.__name__: f for f in (op1_warc_archives, op2_substring_dedup, op3_shard_by_size, op4_exact_dedup, op5_byte_bpe, op6_minhash_near_dedup,
                                 op7_url_filter, op8_mixture_packing, op9_near_vectors,
                                 op10_language_id, op11_periodic_runs, op12_hard_negatives,
                                 op13_benchmark_decontamination)}
ORACLES = {"op1_warc_archives": OP1_SQL, "op2_substring_dedup": OP2_SQL, "op4_exact_dedup": OP4_SQL, "op6_minhash_near_dedup": OP6_SQL,
           "op7_url_filter": OP7_SQL, "op9_near_vectors": OP9_SQL,
           "op12_hard_negatives": OP12_SQL, "op13_benchmark_decontamination": OP13_SQL}
