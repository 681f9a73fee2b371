"""Sums that do not depend on the order, against ``math.fsum``."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalograph.functions.exact import exact_deviation, exact_mean, exact_sums


def one(df):
    return df.first().total


def test_a_million_mixed_values(spark, tmp_path):
    rng = np.random.default_rng(1)
    values = rng.standard_normal(1_000_000) * 10.0 ** rng.integers(-30, 30, 1_000_000)
    spark.createDataFrame(pd.DataFrame({"x": values})).write.parquet(f"{tmp_path}/x")
    df = spark.read.parquet(f"{tmp_path}/x")
    expected = math.fsum(values)
    assert one(exact_sums(df, "x")) == expected
    for n in (3, 17):
        assert one(exact_sums(df.repartition(n, F.rand(n)), "x")) == expected
    assert df.agg(F.sum("x")).first()[0] != expected  # which plain sums do not give


CASES = [
    [],
    [None, float("nan"), float("inf"), float("-inf")],
    [0.0, -0.0],
    [0.1] * 10,
    [1e308, 1e308, -1e308, -1e308, 5e-324],
    [1e308, 1e308],
    [-1e308, -1e308],
    [5e-324, 2.2250738585072014e-308, -5e-324],
    [2.0**k for k in range(-1074, 1024, 7)],
    [-(2.0**k) + 2.0 ** (k - 52) if k > -900 else 2.0**k for k in range(-1000, 1023, 31)],
    [2.0**32, 2.0**32 - 2.0**-20, -(2.0**32), 1 - 2.0**-53, 2.0**-32, 2.0**-64],
    [1e16, 1.0, -1e16],
]


@pytest.mark.parametrize("values", CASES, ids=range(len(CASES)))
def test_ends_of_the_scale(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    finite = [v for v in values if v is not None and math.isfinite(v)]
    row = exact_sums(df, "x").first()
    try:
        expected = float(sum(map(Fraction, finite))) if finite else None
    except OverflowError:
        expected = math.inf if finite[0] > 0 else -math.inf
    assert row.total == expected and row.total_n == len(finite)


def test_groups_and_statistics(spark):
    rng = random.Random(2)
    data = [(rng.choice("abc"), rng.uniform(-1e6, 1e6) * 10 ** rng.randint(-8, 8)) for _ in range(3000)] + [("d", None)]
    df = spark.createDataFrame(data, "k string, x double").repartition(5)
    found = {r.k: (r.total, r.total_n) for r in exact_sums(df, "x", ["k"]).collect()}
    for k in "abc":
        own = [x for c, x in data if c == k]
        assert found[k] == (math.fsum(own), len(own))
    assert found["d"] == (None, 0)
    values = [x for _, x in data if x is not None]
    mean = math.fsum(values) / len(values)
    dev = math.sqrt(math.fsum((x - mean) ** 2 for x in values) / (len(values) - 1))
    stats = {df.repartition(n).select(exact_mean(df, "x").alias("m")).limit(1).select("m", exact_deviation(df, "x", F.lit(mean)).alias("d")).first() for n in (1, 6)}
    assert len(stats) == 1
    (row,) = stats
    assert row.m == mean and math.isclose(row.d, dev, rel_tol=1e-12)
