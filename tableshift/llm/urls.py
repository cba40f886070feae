"""URL filtering: a blocked Bloom filter of listed canonical URLs passes possible hits to an exact hash join. DataFrame
functions only.

A rule is (action, host, path). It fits its host and all subdomains where the URL's path starts with the rule's. A rule is
listed as ``host + path``; for a URL, only the keys that some rule's shape (number of labels, length of path) could match are
built, so a key is found or not, without comparing rules with URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableshift.llm.bloom import blocked_bloom, may_contain
from tableshift.llm.exact_dedup import LOWER, UPPER

_PARTS = r"^(?s)(?:.*?)://([^/?#]*)([^?#]*)"
MOST_SHAPES = 100_000  # distinct (labels, path length) of a rule list; far beyond what hosts and paths allow


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def judge_urls(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url",
               default: str = "allow", filter_blocks: int = 1 << 12) -> DataFrame:
    """One row per input row: (page_id, host, path, rule, verdict).

    The longest fitting rule wins (length of host and path together, then the longer host); without one ``rule`` is null and
    the verdict is ``default``. Of rules that repeat a host and path, ``block`` wins over ``allow``. Rules with a null host,
    path or action are ignored. A null URL, or one without ``://``, has an empty host and path. Repeated pages and URLs are
    judged alike; other columns are ignored whatever their names; empty tables give an empty result, or no rule.
    """
    listed = (rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "action")
              .dropna().groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"))
              .withColumn("key", F.concat("rule_host", "rule_path")))
    shape = [F.size(F.split("rule_host", r"\.", -1)).alias("labels"), F.length("rule_path").alias("path_length")]
    shapes = listed.select(*shape).distinct().limit(MOST_SHAPES + 1).collect()
    if len(shapes) > MOST_SHAPES:
        raise ValueError(f"rules of more than {MOST_SHAPES} shapes")
    parsed = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).cast("string").alias("url")).select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    sites = parsed.select("host", "path").distinct()
    shapes = sorted(map(tuple, shapes)) or [(1 << 30, 0)]  # without rules, a shape that nothing fits
    options = F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(b).alias("path_length")) for a, b in shapes])
    fits = F.filter(options, lambda s: (s["labels"] <= F.col("parts")) & (s["path_length"] <= F.length("path")))
    keys = (sites.withColumn("parts", F.size(F.split("host", r"\.", -1))).withColumn("shape", F.explode(fits))
            .withColumn("key", F.concat(F.expr("substring_index(host, '.', -shape.labels)"),
                                        F.expr("substring(path, 1, shape.path_length)"))))
    bloom = blocked_bloom(listed, "key", filter_blocks)
    possible = may_contain(keys, "key", bloom, filter_blocks).filter("bloom_hit").select("host", "path", "key")
    best = F.max(F.struct(F.length("key").alias("n"), F.length("rule_host").alias("h"), "key", "action")).alias("best")
    found = (possible.join(listed, "key").groupBy("host", "path").agg(best)
             .select("host", "path", F.col("best.key").alias("rule"), F.col("best.action").alias("action")))
    return parsed.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))
