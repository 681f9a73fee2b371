"""Exact top-k against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from catalograph.llm import topk

SCHEMA = "id long, vector array<long>"


def brute(rows, divisor, k):
    rows = [(n, i, v) for n, (i, v) in enumerate(rows) if v is not None and None not in v]
    out = []
    for n, own, asked in rows:
        if own is None or own % divisor:
            continue
        scored = [(-sum(a * b for a, b in zip(asked, v)), i is None, i or 0) for m, i, v in rows if m != n and len(v) == len(asked)]
        out += [(own, rank + 1, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def run(spark, rows, divisor, k, slices=2):
    out = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("id") % divisor == 0, k, slices)
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("slices", [1, 2, 3])
@pytest.mark.parametrize("top", [3, 10**6, 1 << 30])
def test_against_brute_force(spark, monkeypatch, slices, top):
    """Small blocks, ties, one vector many times; numbers beyond what doubles hold exactly."""
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = random.Random(slices)
    rows = [(i, [rng.randint(-top, top) for _ in range(5)]) for i in range(120)] + [(i, [top, 1, 0, -1, top]) for i in range(120, 180)]
    rng.shuffle(rows)
    assert run(spark, rows, 17, 4, slices) == brute(rows, 17, 4)


def test_awkward(spark):
    rows = [(0, [1, 2]), (1, None), (2, [None, 1]), (3, [1, 2]), (3, [1, 2]), (4, [1, 2, 3]), (None, [1, 1]), (5, []), (6, []), (7, [-1, -2])]
    for k in (1, 3, 10):
        assert run(spark, rows, 1, k) == brute(rows, 1, k)
    assert run(spark, [], 1, 3) == [] and run(spark, rows, 99, 3) == brute(rows, 99, 3)


def test_only_the_own_row_is_left_out(spark):
    """Two rows of one id are two queries, and candidates of each other."""
    rows = [(50, [1, 2]), (50, [5, 5]), (1, [1, 0]), (2, [0, 1])]
    assert run(spark, rows, 50, 2) == [(50, 1, 50, 15), (50, 1, 50, 15), (50, 2, 1, 5), (50, 2, 2, 2)]


def test_whole_vectors(spark):
    cases = [([0.5, -0.001],), ([float("nan")],), ([float("inf"), 1.0],), ([None],), (None,), ([],)]
    df = spark.createDataFrame(cases, "v array<float>").select(topk.whole_vector(F.col("v")))
    assert [r[0] for r in df.collect()] == [[128, -1], None, None, None, None, []]
