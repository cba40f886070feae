import hashlib
import zlib
from collections import defaultdict


from tableshift.llm.bloom import blocked_bloom, may_contain
from tableshift.llm.exact_dedup import LOWER, UPPER, exact_duplicates
from tableshift.llm.shard import shard_by_size
from tableshift.llm.urls import judge_urls

TABLE = str.maketrans(UPPER, LOWER)


def test_exact_duplicates_on_odd_rows(docs_of, odd_rows):
    got = sorted((tuple(r) for r in exact_duplicates(docs_of(odd_rows), prefix=4, filter_blocks=16, digest_all=True).collect()), key=repr)
    groups = defaultdict(list)
    for r in odd_rows:
        groups[(r[1] or "").translate(TABLE)].append(r[0])
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    assert got == sorted(want, key=repr)


def test_exact_duplicates_share_a_prefix_only(docs_of):
    rows = exact_duplicates(docs_of([(1, "a" * 100 + "b"), (2, "a" * 100 + "c"), (3, "É"), (4, "é")])).collect()
    assert all(r.kept and r.group_size == 1 for r in rows)


def test_exact_duplicates_of_nothing(docs_of):
    assert exact_duplicates(docs_of([])).collect() == []


def test_bloom_has_no_false_miss(spark):
    keys = spark.range(3000).selectExpr("cast(id * 3 as string) k")
    rows = spark.range(9000).selectExpr("cast(id as string) k").unionByName(spark.sql("select cast(null as string) k"))
    hits = {r.k for r in may_contain(rows, "k", blocked_bloom(keys, "k", 256), 256).filter("bloom_hit").collect()}
    assert {str(3 * i) for i in range(3000)} <= hits and None not in hits and len(hits) < 3600


def check_shards(rows, got, shards):
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in got:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(shards))
    return sizes


def test_shards_are_even_and_keep_equal_texts(docs_of):
    rows = [(i, f"text {i % 700} " * 20) for i in range(4000)]
    got = shard_by_size(docs_of(rows), 8, ranges=16, least_rows=50, slack=0.01).collect()
    sizes = check_shards(rows, got, 8)
    assert max(sizes.values()) < 1.03 * min(sizes.values())
    homes = defaultdict(set)
    for r in got:
        homes[r.text_crc32].add(r.shard)
    assert sum(len(h) > 1 for h in homes.values()) <= 16


def test_a_hot_group_and_many_empty_records_are_subdivided(docs_of):
    rows = [(i, "same text" * 50) for i in range(1500)] + [(i, None) for i in range(1500, 3500)] + [(i, f"t{i}" * 9) for i in range(3500, 4500)]
    sizes = check_shards(rows, shard_by_size(docs_of(rows), 8, ranges=16, least_rows=50).collect(), 8)
    assert max(sizes.values()) < 1.03 * min(sizes.values())


def test_pairs_of_long_copies_stay_together(docs_of):
    rows = [(i, f"{i % 900} " * (30 + i % 900)) for i in range(1800)] + [(9000, "long " * 2000)]
    got = shard_by_size(docs_of(rows), 16, ranges=64, least_rows=20, slack=0.01).collect()
    sizes = check_shards(rows, got, 16)
    allowance = 5 * 0.01 * sum(sizes.values()) / 16 + 10_001
    assert max(sizes.values()) - min(sizes.values()) <= 2 * allowance
    homes = defaultdict(set)
    for r in got:
        homes[r.text_crc32].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_shards_of_odd_and_no_rows(docs_of, odd_rows):
    rows = [r[:2] for r in odd_rows]
    check_shards(rows, shard_by_size(docs_of(odd_rows), 4).collect(), 4)
    assert shard_by_size(docs_of([]), 4).collect() == []


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "Example.com", "/de"), ("allow", "", ""), ("allow", "a.b", "/x"),
         ("block", "a.b", "/x"), ("allow", None, "/")]
PAGES = [(1, "http://X.Example.net/en/1"), (2, "https://example.net/de"), (3, "http://example.com/dex?q"), (4, "http://badexample.com/de"),
         (5, None), (6, "no scheme"), (7, "http://net"), (8, "http://a.b/x/y#z"), (9, "http://a.b/"), (9, "http://a.b/"),
         (10, "http://x/http://net/"), (11, "://net/\n?"), (12, "http://" + "l." * 5000 + "net/"), (13, "")]


def brute(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:cut].translate(TABLE), rest[cut:]
        path = rest[:min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [(len(h) + len(p), len(h), h.lower() + p, a) for a, h, p in RULES if h is not None
            and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_rules_against_brute_force(spark):
    pages = spark.createDataFrame([(*p, "x", "y") for p in PAGES], "page_id bigint, url string, key string, host string")
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    got = sorted(tuple(r) for r in judge_urls(pages, rules).collect())
    assert [r[:3] + r[3:] for r in got] == sorted((i, *brute(u)) for i, u in PAGES) or got == sorted(
        ((i, *brute(u)) for i, u in PAGES), key=repr)


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string")
    rules = spark.createDataFrame([], "action string, host string, path string")
    assert {r.verdict for r in judge_urls(pages, rules).collect()} == {"allow"}
    assert judge_urls(pages.limit(0), rules).collect() == []
