"""Sums of doubles that do not depend on the order of the rows.

A double is a whole number times a power of two. Each value is shifted into the bin of its exponent (32 powers of two
wide) and split there into whole units and 2**-60ths of a unit, both whole numbers; bins are summed as decimals, which
is exact, so partial sums of any tasks add up to the same. Only the sums of the bins, at most 67 per
group, are put together by arbitrary precision and rounded once: the result is the double nearest to the true
sum, as ``math.fsum`` gives it.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from fractions import Fraction

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.functions.expressions import finite

# Send this module's functions to the executors, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 32  # powers of two in a bin
BITS = 60  # binary places kept below a bin's unit: 53 of a double, and room where the logarithm is off by one


def _nearest(low: list[int], units: list[int], parts: list[int]) -> float | None:
    total = Fraction(0)
    for k, whole, rest in zip(low, units, parts):
        total += (Fraction(int(whole)) + Fraction(int(rest), 1 << BITS)) * Fraction(2) ** (WIDTH * int(k))
    try:
        return float(total)
    except OverflowError:
        return float("inf") if total > 0 else float("-inf")


@F.pandas_udf(T.DoubleType())
def _rounded(bins: pd.Series, units: pd.Series, parts: pd.Series) -> pd.Series:
    return pd.Series([_nearest(*x) if len(x[0]) else None for x in zip(bins, units, parts)], dtype="float64")


def exact_sums(df: DataFrame, column: str, by: Sequence[str] = (), name: str = "total") -> DataFrame:
    """The columns ``by``, ``name`` and ``<name>_n``: sum and number of the finite values of ``column`` per group.

    Other values count as none; a group without any has a NULL sum. Without ``by`` there is one row.
    """
    value = finite(F.col(f"`{column}`").cast("double"))
    found = df.select(*[F.col(f"`{c}`") for c in by], value.alias("_x"))
    bin_ = F.when(F.col("_x") == 0, F.lit(0)).otherwise(F.floor(F.log2(F.abs("_x")) / WIDTH)).cast("int")
    # In two halves, as the power itself may be beyond what doubles hold.
    half = F.pow(F.lit(2.0), F.col("_bin") * (-WIDTH // 2))
    shifted = F.col("_x") * half * half
    found = found.withColumn("_bin", bin_).withColumn("_shifted", shifted)
    whole = F.floor("_shifted")
    # By way of whole numbers: a double becomes a decimal through its shortest text, which is not its value.
    rest = ((F.col("_shifted") - whole) * F.lit(float(1 << BITS))).cast("bigint").cast("decimal(20,0)")
    sums = found.groupBy(*by, "_bin").agg(
        F.sum(whole.cast("decimal(20,0)")).cast("decimal(38,0)").alias("_units"),
        F.sum(rest).cast("decimal(38,0)").alias("_parts"),
        F.count("_x").alias("_n"),
    )
    listed = F.collect_list(F.when(F.col("_n") > 0, F.struct("_bin", "_units", "_parts"))).alias("_sums")
    bins = sums.groupBy(*by).agg(F.sum("_n").alias("_n"), listed)
    total = _rounded(F.col("_sums._bin"), F.col("_sums._units"), F.col("_sums._parts"))
    return bins.select(*[F.col(f"`{c}`") for c in by], total.alias(name), F.coalesce("_n", F.lit(0)).cast("long").alias(f"{name}_n"))


def exact_mean(df: DataFrame, column: str, name: str = "mean") -> Column:
    """Mean of the finite values of ``column`` from their exact sum, as a scalar of one row."""
    sums = exact_sums(df, column, name="s")
    return sums.select(F.try_divide("s", F.col("s_n").cast("double")).alias(name)).scalar()


def exact_deviation(df: DataFrame, column: str, mean: Column) -> Column:
    """Sample deviation of the finite values of ``column`` around ``mean``, from the exact sum of the squares."""
    value = finite(F.col(f"`{column}`").cast("double"))
    squares = df.select(((value - mean) * (value - mean)).alias("square"))
    sums = exact_sums(squares, "square", name="s")
    return sums.select(F.when(F.col("s_n") > 1, F.sqrt(F.col("s") / (F.col("s_n") - 1))).alias("dev")).scalar()
