"""Hard negatives against a full comparison, and the threshold algorithm's early stop."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableshift.llm.negatives import SortedLists, hard_negatives


def brute(rows, positives, negatives, low, high, scale=256):
    once = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            once[i] = min(once.get(i, (str(label), v)), (str(label), v))
    whole = {i: (label, [math.floor(scale * x) for x in v]) for i, (label, v) in once.items()}
    clip = lambda s: max(-2 ** 63, min(2 ** 63 - 1, s))
    out = []
    for a, (label, v) in whole.items():
        if a % 10:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in whole.items() if i != a and len(w) == len(v))
        for score, p, _ in [s for s in scored if s[2] == label][:positives]:
            own = clip(-score)
            inside = [(i, -s) for s, i, other in scored if other != label and low * own <= 100 * -s <= high * own][:negatives]
            out += [(a, p, r, i, own, clip(s)) for r, (i, s) in enumerate(inside, 1)]
    return sorted(out)


def vectors(spark, rows):
    clashing = ("id", "v", "label2", "anchor", "width", "block", "chunk", "rows", "score", "rank", "positive")
    schema = "vec_id bigint, embedding array<double>, label int" + "".join(f", {c} string" for c in clashing)
    return spark.createDataFrame([(*r, *clashing) for r in rows], schema)


def table(seed, count=220, width=6):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1) for _ in range(width)], rng.randrange(3)) for i in range(count)]
    same = [rng.gauss(0, 1) for _ in range(width)]
    rows += [(1000 + i, same, i % 2) for i in range(60)]  # ties in the score, settled by the id
    rows += [(2000, None, 1), (2010, [None] + same[1:], 1), (2020, [math.nan] + same[1:], 1), (2030, [math.inf] + same[1:], 1), (None, same, 1),
             (2040, same, None), (2050, [], 1), (2051, [], 1), (2052, [], 2), (2060, [0.0] * width, 1), (2070, same[:3], 1), (2071, same[:3], 2),
             (1000, same, 0), (1000, same, 2), (2080, [-x for x in same], 0)]
    return rows


@pytest.mark.parametrize("bytes_, anchors", [(8 << 20, 4096), (600, 3)])
def test_against_brute_force(spark, bytes_, anchors):
    rows = table(4)
    got = hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0, block_bytes=bytes_, most_anchors=anchors)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = brute(rows, 5, 10, 30, 90)
    assert sorted(map(tuple, got.collect())) == expected and len(expected) > 500


def test_other_windows(spark):
    rows = table(5)
    got = hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0, positives=2, negatives=3, low=-50, high=40, scale=16, block_bytes=2000)
    assert sorted(map(tuple, got.collect())) == brute(rows, 2, 3, -50, 40, 16)


def test_components_beyond_exact_doubles(spark):
    rng = random.Random(6)
    rows = [(i, [float(rng.randrange(-2 ** 40, 2 ** 40)) + rng.random() for _ in range(3)], i % 2) for i in range(60)]
    rows += [(100 + i, [rng.uniform(-1e30, 1e30) for _ in range(3)], i % 2) for i in range(3)]
    got = hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0, block_bytes=400)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 10, 30, 90)


def test_nothing_to_mine(spark):
    assert hard_negatives(vectors(spark, []), F.col("vec_id") % 10 == 0).collect() == []
    assert hard_negatives(vectors(spark, [(1, [1.0], 0), (2, [1.0], 1)]), F.col("vec_id") % 10 == 0).collect() == []
    assert hard_negatives(vectors(spark, [(10, [1.0], 0), (2, [1.0], 1)]), F.lit(None).cast("boolean")).collect() == []


def test_the_search_stops_early_and_exactly():
    rng = np.random.default_rng(7)
    x = np.floor(rng.standard_normal((5000, 4)) * 256)
    lists, scored = SortedLists(np.arange(5000), np.zeros(5000, np.int64), x), []
    for anchor in np.floor(rng.standard_normal((20, 4)) * 256):
        scores = x @ anchor
        for low, high in ((-np.inf, np.inf), (0.3 * scores.max(), 0.9 * scores.max())):
            (best,), met = lists.search(anchor, np.ones(5000, bool), [(low, high)], 10)
            inside = sorted((-s, i) for i, s in enumerate(scores.tolist()) if low <= s <= high)[:10]
            assert [tuple(b) for b in best] == [(i, -s) for s, i in inside]
            if high == np.inf:
                scored.append(met)
    assert np.mean(scored) < 1500
