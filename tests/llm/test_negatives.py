"""Hard negatives against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalograph.llm import negatives

SCHEMA = "id long, vector array<long>, label int"


def brute(rows, asked, positives=5, most=10, low=30, high=90):
    rows = [(k, i, v, l) for k, (i, v, l) in enumerate(rows) if l is not None and v is not None and None not in v]
    out = []
    for k, own, a, label in rows:
        if own is None or not asked(own):
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), i is None, i or 0, l) for n, i, v, l in rows if n != k and len(v) == len(a)]
        scored.sort()
        for p in [s for s in scored if s[3] == label][:positives]:
            met = [s for s in scored if s[3] != label and low * -p[0] <= 100 * -s[0] <= high * -p[0]]
            out += [(own, None if p[1] else p[2], rank + 1, None if s[1] else s[2], -p[0], -s[0]) for rank, s in enumerate(met[:most])]
    return sorted(out, key=repr)


def run(spark, rows, divisor, **settings):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in negatives.hard_negatives(df, F.col("id") % divisor == 0, **settings).collect()), key=repr)


@pytest.mark.parametrize("top", [2, 300, 1 << 28])
@pytest.mark.parametrize("size", [1, 6])
def test_against_brute_force(spark, monkeypatch, top, size):
    """Many small blocks, ties, one vector many times, numbers beyond what doubles hold exactly."""
    monkeypatch.setattr(negatives, "BLOCK", 60)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 4)
    monkeypatch.setattr(negatives, "FIRST_DEPTH", 2)
    rng = random.Random(size)
    rows = [(i, [rng.randint(-top, top) for _ in range(size)], rng.randint(0, 2)) for i in range(200)]
    rows += [(i, [top] * size, i % 3) for i in range(200, 260)]
    rng.shuffle(rows)
    assert run(spark, rows, 17) == brute(rows, lambda i: i % 17 == 0)
    assert run(spark, rows, 40, positives=2, negatives=3, low=-50, high=100) == brute(rows, lambda i: i % 40 == 0, 2, 3, -50, 100)


def test_awkward(spark):
    rows = [(0, [1, 2], 0), (0, [2, 2], 0), (10, [3, 1], 1), (10, [3, 1], 1), (10, [3, 1], 0), (1, None, 0), (2, [None, 1], 0), (3, [1, 1], None)]
    rows += [(None, [1, 1], 0), (None, [1, 1], 1), (4, [1, 2, 3], 0), (20, [1, 1, 1], 1), (5, [], 0), (30, [], 0), (6, [], 1), (40, [0, 0], 0), (50, [-3, -3], 1), (7, [1, 1], 1)]
    for most in (1, 3, 20):
        settings = {"positives": most, "negatives": most}
        assert run(spark, rows, 10, **settings) == brute(rows, lambda i: i % 10 == 0, most, most)
    assert run(spark, [], 10) == [] and run(spark, rows[:1], 10) == []


def test_reading_stops_early():
    """A strong direction: few rows are read, and the rows are right."""
    rng = np.random.default_rng(1)
    vectors = rng.integers(-5, 5, (4000, 4))
    vectors[:, 0] = rng.integers(-4000, 4000, 4000)
    lists = negatives.SortedLists(vectors)
    seen = []
    score = lists.scores
    lists.scores = lambda rows, anchor: seen.append(len(rows)) or score(rows, anchor)
    anchor = np.array([100, 1, -1, 0])
    ((rows, scores),) = lists.first(anchor, np.ones(4000, bool), [(None, None)], 10)
    whole = vectors @ anchor
    assert scores.tolist() == sorted(whole.tolist(), reverse=True)[:10]
    assert (whole[rows] == scores).all() and sum(seen) < 400
