"""Row counts and duplicate profiles. Each result is one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.functions import has_all_keys


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n): one row per table."""
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _key_value(keys: Sequence[str]) -> Column:
    # A struct is itself never NULL, so a key holding NULLs counts as a value;
    # count_distinct(a, b) would skip it.
    return F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)


def dup_profile(
    df: DataFrame,
    keys: Sequence[str],
    ignore_null_keys: bool,
    names: tuple[str, str, str] = ("total_lignes", "couples_uniques", "nb_doublons"),
) -> DataFrame:
    """One row: number of rows, exact number of distinct keys, their difference.

    With ``ignore_null_keys`` only rows with every key set are profiled. Without
    it all rows are, a pair of keys holding NULLs being a value like any other
    (a single NULL key is never a distinct value).

    The distinct count pre-aggregates by key before its shuffle, so a hot key
    costs one row per map task.
    """
    rows = df.where(has_all_keys(keys)) if ignore_null_keys else df
    total, unique, dups = names
    distinct = F.count_distinct(_key_value(keys))
    return rows.agg(
        F.count("*").alias(total), distinct.alias(unique), (F.count("*") - distinct).alias(dups)
    )


def dup_count(df: DataFrame, keys: Sequence[str], name: str = "nb_doublons") -> DataFrame:
    """One row: how many rows repeat an earlier key, NULLs equalling each other."""
    return df.agg((F.count("*") - F.count_distinct(F.struct(*keys))).alias(name))


def type_filter_counts(df: DataFrame, column: str = "post_type", value: str = "product") -> DataFrame:
    """One row: rows read, kept and rejected by the strict type filter."""
    kept = F.coalesce(F.col(column) == value, F.lit(False))
    return df.agg(
        F.count("*").alias("n_in"), F.count_if(kept).alias("n_kept"), F.count_if(~kept).alias("n_rejected")
    )
