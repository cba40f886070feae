"""Exact and proximity matches against a search written out."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tableshift.llm.phrases import contamination, phrase_matches, positional_index, tokens
from tests.llm.conftest import CLASHING, words

PARTS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return PARTS.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def windows_of(items, width):
    for i, text in items:
        w = words_of(text)
        if i is not None and w:
            for a in range(max(1, len(w) - width + 1)):
                yield i, tuple(w[a:a + width])


def brute(docs, items, width=10):
    wanted = {}
    for i, t in windows_of(items, width):
        wanted.setdefault(t, set()).add(i)
    lengths, out = {len(t) for t in wanted}, []
    for d, text in docs:
        w, hit, found = words_of(text), set(), set()
        for n in lengths:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in wanted:
                    hit |= set(range(a, a + n))
                    found |= wanted[tuple(w[a:a + n])]
        listed = ",".join(sorted(map(str, found)))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def brute_near(docs, items, width, slop):
    out = set()
    for d, text in docs:
        w = words_of(text)
        for i, t in windows_of(items, width):
            for a in range(len(w)):
                if w[a] not in t:
                    continue
                b = next((b for b in range(a, min(len(w), a + len(t) + slop)) if set(t) <= set(w[a:b + 1])), None)
                if b is not None and not set(t) <= set(w[a + 1:b + 1]):
                    out.add((d, i, a, b - a + 1))
    return sorted(out)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.none() | st.text("aB1é -_\t\n\x00本Ä", max_size=20), max_size=8))
def test_tokens(texts):
    values, counts = tokens(pa.array(["skipped", *texts], pa.string())[1:])
    expected = [words_of(t) for t in texts]
    assert counts.tolist() == [len(w) for w in expected] and values.to_pylist() == [x for w in expected for x in w]


def corpus(rng, count=120, vocabulary=60):
    items = [(i, words(rng, rng.choice((0, 3, 9, 10, 11, 40)), vocabulary)) for i in range(30)]
    items += [(100, items[5][1]), (101, None), (None, "w1 w2 w3"), (102, "W7!"), (5, "other words for item five"), (103, "w1 w1 w1 w2 " * 3), (104, "--- ...")]
    docs = [(i, words(rng, rng.randrange(0, 80), vocabulary)) for i in range(count)]
    for d in range(0, count, 3):
        text = (items[rng.randrange(30)][1] or "").split()
        a = rng.randrange(len(text) + 1)
        docs.append((1000 + d, " ".join(words(rng, 5, vocabulary).split() + [x.upper() + ";" for x in text[a:a + 25]] + ["Ende"])))
    docs += [(2000, "w1 w1 w1 w2 " * 200), (2001, None), (2002, ""), (None, items[8][1]), (2003, "Äw7 w7ß -w7-"), (1000, "again w7")]
    return docs, items


def frames(spark, docs_of, docs, items):
    schema = "item_id bigint, text string" + "".join(f", {c} string" for c in CLASHING if c != "text")
    return docs_of(docs), spark.createDataFrame([(*r, *(c for c in CLASHING if c != "text")) for r in items], schema)


@pytest.mark.parametrize("segment, block", [(4 << 20, 1 << 16), (4000, 300)])
def test_contamination_against_brute_force(spark, docs_of, odd_rows, segment, block):
    docs, items = corpus(random.Random(2))
    docs += [(r[0], r[1]) for r in odd_rows]
    got = contamination(*frames(spark, docs_of, docs, items), segment_bytes=segment, block=block)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_phrases_and_proximity(spark, docs_of):
    docs, items = corpus(random.Random(3), 60, 12)
    docs = [d for d in docs if d[0] is not None]
    frame = frames(spark, docs_of, docs, items)
    exact = sorted({(d, i, a, len(t)) for d, text in docs for i, t in windows_of(items, 4) for w in [words_of(text)]
                    for a in range(len(w) - len(t) + 1) if tuple(w[a:a + len(t)]) == t})
    assert sorted({tuple(r) for r in phrase_matches(*frame, width=4).collect()}) == exact
    for slop in (0, 3):
        got = sorted({tuple(r) for r in phrase_matches(*frame, width=4, slop=slop, segment_bytes=3000).collect()})
        assert got == brute_near(docs, items, 4, slop)


def test_empty_tables(spark, docs_of):
    docs, items = corpus(random.Random(4), 10)
    assert contamination(*frames(spark, docs_of, [], items)).collect() == []
    got = contamination(*frames(spark, docs_of, docs, [])).collect()
    assert len(got) == len(docs) and not any(r.contaminated for r in got)


def test_the_whole_index(spark, docs_of):
    docs = [(1, "b a b"), (2, None), (3, "A c")]
    row = positional_index(docs_of(docs).repartition(1)).collect()
    assert sum(len(r.doc_ids) for r in row) == 3
    terms = {t: n for r in row for t, n in zip(r.terms, r.counts)}
    assert terms == {"b": 2, "a": 2, "c": 1}
