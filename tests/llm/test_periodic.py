"""Periodic runs against a definition written out, and the planted test corpus."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tableshift.llm.periodic import branching_tandems, must_repeat, periodic_runs, periodic_stretches, suffix_array, with_planted_period
from tableshift.llm.queries import op11_periodic_runs
from tests.llm.conftest import words


def smallest_period(s):
    return next(q for q in range(1, len(s) + 1) if all(s[i] == s[i + q] for i in range(len(s) - q)))


def brute(s, least, times):
    """Every maximal stretch by comparing the text with itself at every distance."""
    found = set()
    for q in range(1, len(s) // times + 1):
        i = 0
        while i < len(s) - q:
            j = i
            while j < len(s) - q and s[j] == s[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q) and smallest_period(s[i:i + length]) == q:
                found.add((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("ab") | st.sampled_from("abc"), max_size=60), st.integers(1, 9), st.integers(2, 4))
def test_stretches_are_all_maximal_runs(s, least, times):
    codes = np.array([ord(c) for c in s], np.int64)
    assert sorted(periodic_stretches(codes, least, times), key=lambda r: (r[0], r[2])) == brute(s, least, times)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=50))
def test_suffix_array_and_tandems(s):
    order, common = suffix_array(np.array(s, np.int64))
    assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
    for k in range(1, len(s)):
        a, b = s[order[k - 1]:], s[order[k]:]
        assert common[k] == next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
    ends, halves = branching_tandems(np.array(s, np.int64), order, common)
    expected = {(i + 2 * d, d) for i in range(len(s)) for d in range(1, (len(s) - i) // 2 + 1)
                if s[i:i + d] == s[i + d:i + 2 * d] and (i + 2 * d == len(s) or s[i + 2 * d] != s[i + d])}
    assert set(zip(ends.tolist(), halves.tolist())) == expected


def test_what_every_run_repeats():
    assert must_repeat(24, 3) == 16
    assert [must_repeat(n, 2) for n in (1, 2, 7)] == [1, 1, 4]


def expected_row(doc_id, text, least=24, times=3):
    w = (text or "").encode().split()
    found = brute(w, least, times)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return doc_id, len(w), tuple(found), top, hashlib.sha256(kept).hexdigest(), kept.decode()


def periodic_rows(rng):
    rows = [(100, " ".join(["a b"] * 12)), (101, "x " * 23), (102, "x " * 24), (103, " ".join(["a b c d e f g h"] * 3)),
            (104, "y " + " ".join(["a b a b c"] * 9) + " z"), (105, " ".join(["q"] * 30 + ["r"] + ["q"] * 40)), (106, "\t\n" + "ä ß " * 20)]
    for k in range(40):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            unit = words(rng, rng.randrange(1, 9), 4).split()
            parts += words(rng, rng.randrange(0, 30), 30).split() + (unit * 12)[:rng.randrange(5, 70)]
        rows.append((200 + k, " ".join(parts)))
    return rows


def test_rows_against_brute_force(spark, docs_of, odd_rows):
    rows = [r for r in odd_rows if r[0] != 6] + periodic_rows(random.Random(3))
    got = [(r[0], r[1], tuple(tuple(x) for x in r[2]), r[3] and tuple(r[3]), r[4], r[5])
           for r in periodic_runs(docs_of(rows), with_text=True).collect()]
    assert sorted(got, key=repr) == sorted((expected_row(r[0], r[1]) for r in rows), key=repr)


def test_other_parameters(spark, docs_of):
    rows = periodic_rows(random.Random(8))
    got = [(r.doc_id, tuple(tuple(x) for x in r.runs)) for r in periodic_runs(docs_of(rows), least=5, times=2).collect()]
    assert sorted(got) == sorted((i, tuple(brute(t.encode().split(), 5, 2))) for i, t in rows)
    with pytest.raises(ValueError):
        periodic_runs(docs_of(rows), times=1)


def test_very_long_and_empty(spark, docs_of):
    rng = random.Random(1)
    long_run = " ".join(["w"] * 60_000)
    mixed = words(rng, 30_000, 5_000) + " " + " ".join(words(rng, 700, 5_000).split() * 50)
    got = {r.doc_id: r for r in periodic_runs(docs_of([(1, long_run), (2, mixed), (3, "v" * 300_000)])).collect()}
    assert [tuple(r) for r in got[1].runs] == [(0, 60_000, 1)]
    assert len(got[2].runs) == 1 and got[2].top.period == 700 and got[2].top.length >= 35_000
    assert got[3].runs == [] and got[3].top is None
    assert periodic_runs(docs_of([])).collect() == []


def planted_brute(doc_id, text):
    w, h = (text or "").encode().split(), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return text
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(w[a + (i - a) % p] if i >= a else w[i] for i in range(n)).decode()


def test_query_against_brute_force(spark, tmp_path):
    """The registered query over a small table of its own, digests included."""
    rng = random.Random(9)
    rows = [(i, words(rng, rng.randrange(0, 120), 50)) for i in range(150)] + [(500 + i, t) for i, t in periodic_rows(rng)]
    rows += [(10, None), (None, "a " * 40), (11, ""), (12, "\n x\ty  z \n" * 9)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    planted = [(i, planted_brute(i, t)) for i, t in rows]
    texts = with_planted_period(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, texts), key=repr) == sorted(planted, key=repr)
    assert sum(a != b for a, b in zip(rows, planted)) > 5
    expected = []
    for i, t in planted:
        _, _, found, top, digest, _ = expected_row(i, t)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        expected.append((i, len(found), *(top or (None, None, None)), top and 1000 * top[1] // top[2],
                         hashlib.sha256(listed.encode()).hexdigest(), digest))
    got = op11_periodic_runs(spark, str(tmp_path)).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                                                         "runs_sha256", "collapsed_sha256")
    assert got.dtypes[:6] == [(c, "bigint") for c in got.columns[:6]]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
