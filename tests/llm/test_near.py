import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql.readwriter import DataFrameWriter

from tableshift.llm.components import components
from tableshift.llm.embeddings import near_vectors, plan_tables
from tableshift.llm.exact_dedup import LOWER, UPPER
from tableshift.llm.fm_index import FmIndex
from tableshift.llm import neardup
from tableshift.llm.neardup import chunks_needed, keys_of, near_duplicates, signatures
from tableshift.llm.substrings import _spans, remove_repeats, strip_repeats
from tests.llm.conftest import words

TABLE = str.maketrans(UPPER, LOWER)


def reached(nodes, links):
    home = {n: n for n in nodes}
    def root(n):
        while home[n] != n:
            n = home[n]
        return n
    for a, b in links:
        a, b = root(a), root(b)
        home[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 400)] + [(rng.randrange(500, 900), rng.randrange(500, 900)) for _ in range(250)]
    links += [(7, 7), (None, 3), (5, 4), (5, 4)]
    df = spark.createDataFrame(links, "x bigint, y bigint")
    got = {r.node: r.component for r in components(df, "x", "y").collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == reached({n for l in real for n in l}, real)
    assert components(df.limit(0), "x", "y").collect() == []


def test_components_write_few_steps_and_few_files(spark, monkeypatch):
    """Stars are seen as such at once, and a short table is not written as a file per shuffle partition."""
    links = spark.range(2000).selectExpr("id + 100 as x", "id % 100 as y")
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    written, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (written.append(path), write(self, path, *a, **k))[1])
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.node: r.component for r in components(links, "x", "y").collect()}
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert got == reached(got, [(i + 100, i % 100) for i in range(2000)])
    files = [len(spark.read.parquet(p).inputFiles()) for p in written[1:]]
    assert max(files) <= 16
    star = spark.range(300).selectExpr("id + 1 as x", "0L as y")
    written.clear()
    assert {r.component for r in components(star, "x", "y").collect()} == {0} and len(written) == 3


def test_chunks_that_differ_in_one_symbol():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 3, (500, 12)).astype(np.uint16)
    b = rng.integers(0, 3, (500, 12)).astype(np.uint16) << np.uint16(15)
    differ = neardup._differing(a.view(np.uint64), b.view(np.uint64))
    assert (np.bitwise_count(differ) == (a != b).reshape(500, 3, 4).sum(axis=2)).all()
    keys_a, keys_b = keys_of(a), keys_of(b)
    same = keys_a == keys_b
    assert neardup._first_key(differ).tolist() == [int(s.argmax()) if s.any() else -1 for s in same]


def shingles(text):
    own = (text or "").translate(TABLE).encode().split()
    return {tuple(own[i:i + 5]) for i in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)} if own else set()


def near_brute(rows, percent):
    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    links = [(a, b) for a, b in combinations([i for i in sets if sets[i]], 2)
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    home = reached(sets, links)
    return sorted(((i, len(shingles(t)), home.get(i), i == home.get(i)) for i, t, *_ in rows), key=repr)


def copies(rng, count, changes):
    base = words(rng, 150, 5000).split()
    out = []
    for _ in range(count):
        own = list(base)
        for _ in range(rng.randrange(changes + 1)):
            own[rng.randrange(len(own))] = f"new{rng.randrange(10**9)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("percent,block,sets", [(85, 512, 256), (80, 16, 8)])
def test_near_duplicates_against_brute_force(docs_of, odd_rows, percent, block, sets, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_SETS", sets)
    rng = random.Random(percent)
    texts = [t for _ in range(6) for t in copies(rng, 12, 6)] + copies(rng, 60, 5) + copies(rng, 60, 9) + [words(rng, 80) for _ in range(40)] + ["a b", "A  b", "c d e"]
    rng.shuffle(texts)
    rows = [*odd_rows, *[(100 + i, t) for i, t in enumerate(texts)]]
    got = sorted((tuple(r) for r in near_duplicates(docs_of(rows), percent=percent, block=block).collect()), key=repr)
    assert got == near_brute(rows, percent)


def test_shared_shingles():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 300, rng.integers(0, 90))).astype(np.uint64) for _ in range(40)]
    shared = neardup._shared_shingles(sets[:25], sets[25:], width=16)
    assert shared.tolist() == [[len(np.intersect1d(a, b)) for b in sets[25:]] for a in sets[:25]]


def test_near_duplicates_of_nothing(docs_of):
    assert near_duplicates(docs_of([])).collect() == []


def test_signatures_within_the_distance_share_a_key():
    rng, m = np.random.default_rng(1), chunks_needed(0.85)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, 4 * m).astype(np.uint16)
        b = a.copy()
        at = rng.choice(4 * m, rng.integers(0, 2 * m), replace=False)
        b[at] ^= 1
        assert (keys_of(a[None])[0] == keys_of(b[None])[0]).any()
    sets = [np.arange(5, dtype=np.uint64), np.zeros(0, np.uint64), np.arange(5, dtype=np.uint64)]
    s = signatures(sets, 8, 1)
    assert (s[0] == s[2]).all() and not s[1].any()


def test_fm_index_against_scanning():
    rng = np.random.default_rng(4)
    text = np.concatenate([np.concatenate((rng.integers(1, 4, rng.integers(1, 60)), [0])) for _ in range(30)]).astype(np.int64)
    index = FmIndex(text, 4, 7)
    ends = np.array([e for e in range(7, len(text)) if (text[e - 7:e] > 0).all()])
    matched, low, high = index.intervals(text, ends, 7)
    for e, m, a, b in zip(ends, matched, low, high):
        places = [i for i in range(len(text) - m + 1) if (text[i:i + m] == text[e - m:e]).all()]
        assert sorted(index.order[a:b].tolist()) == places and (m == 7 or len(places) == 1)


def test_fm_index_starts_from_a_table_of_runs(monkeypatch):
    rng = np.random.default_rng(14)
    text = np.append(rng.integers(1, 50, 3000), 0).astype(np.int64)
    index = FmIndex(text, 50, 13)
    assert 2 <= index.run <= 4 and len(index.runs) - 1 == len({tuple(text[i:i + index.run]) for i in range(len(text))})
    steps, extend = [], FmIndex.extend
    monkeypatch.setattr(FmIndex, "extend", lambda self, low, high, symbol: (steps.append(len(low)), extend(self, low, high, symbol))[1])
    ends = np.arange(13, 3000)
    matched, low, high = index.intervals(text, ends, 13)
    assert sum(steps) < len(ends) and all(m >= index.run for m in matched)
    for e, m, a, b in zip(ends, matched, low, high):
        assert e - m in index.order[a:b] and all((text[i:i + m] == text[e - m:e]).all() for i in index.order[a:b])
    assert index.intervals(text, np.array([9]), 1)[0].tolist() == [1]


def test_spans_of_many_rows_at_once(spark):
    rng, rows, want = np.random.default_rng(15), [], []
    for r in range(300):
        least = rng.integers(0, 3, rng.integers(1, 40)) + r - 1
        first = int(rng.integers(0, 50))
        rows.append((r, r % 7, first, bytearray(least.astype(np.int64).tobytes())))
        hit = np.flatnonzero(least < r)
        parts = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1) if len(hit) else []
        if parts:
            want.append((r, r % 7, [(int(p[0]) + first, int(p[-1]) + first + 13) for p in parts]))
    met = spark.createDataFrame(rows, "doc_id bigint, text_hash int, first int, least_of binary").repartition(3)
    got = [(r.doc_id, r.text_hash, [tuple(x) for x in np.frombuffer(r.spans, np.int32).reshape(-1, 2).tolist()]) for r in _spans(met, 13).collect()]
    assert sorted(got) == want


def repeats_brute(rows, window):
    first = {}
    for i, t, *_ in rows:
        own = (t or "").encode().split()
        for k in range(len(own) - window + 1) if i is not None else ():
            key = tuple(own[k:k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t, *_ in rows:
        own = (t or "").encode().split()
        gone = {k + j for k in range(len(own) - window + 1) if i is not None and first[tuple(own[k:k + window])] < i for j in range(window)}
        out.append((i, len(own), len(gone), b" ".join(w for k, w in enumerate(own) if k not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot,shard_bytes", [(20_000, 8 << 20), (3, 4000), (20_000, 4000)])
def test_repeats_against_brute_force(docs_of, odd_rows, hot, shard_bytes):
    rng = random.Random(hot)
    passages = [words(rng, n) for n in (12, 13, 14, 60, 200)]
    rows = [*odd_rows, (50, passages[3]), (49, None)]
    for i in range(60):
        parts = [words(rng, rng.randrange(30), 6 if i % 5 == 0 else 3000)]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), words(rng, rng.randrange(12))]
        rows.append((100 + i, "\n ".join(parts)))
    rows += [(30, rows[-1][1]), (31, rows[-2][1].upper()), (100, rows[11][1])]
    rows += [(32, "x y z " * 300), (33, "begin " + "y z x " * 200 + "end"), (34, "0 " * 500), (35, "0 " * 400)]  # one segment each
    docs = docs_of(rows)
    got = remove_repeats(docs, hot=hot, shard_bytes=shard_bytes, with_text=True).collect()
    want = repeats_brute(rows, 13)
    assert sorted(((r.doc_id, r.n_words, r.n_removed) for r in got), key=repr) == [w[:3] for w in want]
    assert sorted(((r.doc_id, " ".join((r.kept_text or "").encode().decode().split())) for r in got if r.n_removed), key=repr) == [
        *sorted(((w[0], w[3]) for w in want if w[2]), key=repr)]
    stripped = strip_repeats(docs, window=13, hot=hot, shard_bytes=shard_bytes)
    assert stripped.columns == docs.columns and stripped.count() == len(rows)
    texts = {(w[0], w[1] - w[2]): w[3] for w in want if w[2]}
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in stripped.collect())
    assert set(texts.values()) <= {r.text for r in stripped.collect()}


def test_repeats_of_nothing(docs_of):
    assert remove_repeats(docs_of([])).collect() == [] and strip_repeats(docs_of([])).collect() == []


def vectors_brute(rows, threshold):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        v = v / np.abs(v).max()
        return v / np.sqrt(v @ v)
    units = [unit(v) if i is not None and l is not None else None for i, v, l in rows]
    links = [(a, b) for a, b in combinations(range(len(rows)), 2) if units[a] is not None and units[b] is not None
             and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold]
    home = reached({r[0] for r in rows if r[0] is not None}, [(rows[a][0], rows[b][0]) for a, b in links])
    return sorted(((i, sum(k in l for l in links), home.get(i), i == home.get(i)) for k, (i, _, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("block", [1024, 20])
def test_near_vectors_against_brute_force(spark, block):
    rng, rows = np.random.default_rng(block), []
    for c in range(30):
        base = rng.standard_normal(16)
        rows += [(1000 + 10 * c + k, [float(x) for x in np.float32(base + rng.standard_normal(16) * 0.18)], c % 3) for k in range(8)]
    same = [float(x) for x in np.float32(rng.standard_normal(16))]
    rows += [(10 + k, same, 1) for k in range(30)] + [(60, [2 * x for x in same], 1), (61, same, 2), (62, same, None), (None, same, 1)]
    rows += [(63, None, 1), (64, [], 1), (65, [0.0] * 16, 1), (66, [*same[:15], None], 1), (67, [*same[:15], float("nan")], 1),
             (68, [*same[:15], float("inf")], 1), (69, same[:8], 1), (70, [x * 1e37 for x in same], 1), (10, same, 1)]
    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id bigint, embedding array<float>, label int, id string, v string")
    by_id = lambda r: (str(r[0]), repr(r))
    got, want = sorted((tuple(r) for r in near_vectors(df, block=block).collect()), key=by_id), sorted(vectors_brute(rows, 0.93), key=by_id)
    # A pair right at the threshold is found with probability 0.999; what is found is right.
    assert [g[0] for g in got] == [w[0] for w in want] and all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.995 * sum(w[1] for w in want)
    assert sum(g != w for g, w in zip(got, want)) <= 0.02 * len(want)
    assert [g for g in got if g[0] is None or g[0] < 1000] == [w for w in want if w[0] is None or w[0] < 1000]
    assert near_vectors(df.limit(0)).collect() == []


def test_planned_recall():
    for n in (10, 10**4, 10**9):
        signs, tables = plan_tables(n, 0.93, 0.999)
        assert 1 - (1 - (1 - np.arccos(0.93) / np.pi) ** signs) ** tables >= 0.999


def test_one_id_with_two_texts_gives_one_row_per_input_row(docs_of):
    rng = random.Random(8)
    x, y, z = (words(rng, 150, 5000) for _ in range(3))
    rows = [(1, x), (1, y), (2, x), (3, y + " more"), (4, y), (5, z)]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs_of(rows), percent=85).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 1, False), (5, 5, True)]
