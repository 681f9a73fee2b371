"""Keyed de-duplication with a deterministic survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.functions import has_all_keys
from catalograph.operators.profile import dup_profile


def _free_name(df: DataFrame, base: str) -> str:
    while base in df.columns:
        base = "_" + base
    return base


def _first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    order_by = [o for o in order_by if isinstance(o, Column) or o not in keys]  # a key is the same in all its rows
    if not others and not order_by:
        # The key is the whole row: a hash aggregate, combined before the shuffle.
        return df.dropDuplicates(list(keys))
    if any(isinstance(o, Column) for o in order_by):
        return _first_by_rank(df, keys, order_by, others)
    return _first_by_minimum(df, keys, [*order_by, *(c for c in others if c not in order_by)])


def _comparable(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.MapType):  # maps have no order of their own
        return F.array_sort(F.map_entries(column))
    return column


def _first_by_minimum(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The smallest struct of the other columns per key.

    An aggregate: each map task sends one row per key, whatever its share of the
    rows, and sorts by the key alone.
    """
    fields = []
    for i, name in enumerate(order):
        value = _comparable(df, name)
        fields += [value.isNull().alias(f"null{i}"), value.alias(f"value{i}")]  # NULLs last
    first = _free_name(df, "first")
    best = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias(first))
    place = {name: i for i, name in enumerate(order)}

    def result(name: str) -> Column:
        if name not in place:
            return F.col(f"`{name}`")
        value = F.col(f"{first}.value{place[name]}")
        is_map = isinstance(df.schema[name].dataType, T.MapType)
        return (F.map_from_entries(value) if is_map else value).alias(name)

    return best.select(*[result(c) for c in df.columns])


def _first_by_rank(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], others: Sequence[str]
) -> DataFrame:
    """Row number 1 per key, for any sort order.

    Spark limits each map task to one row per key before the shuffle
    (WindowGroupLimit), so a hot key is never gathered in one task.
    """

    def ascending(name: str) -> Column:
        return _comparable(df, name).asc_nulls_last()

    order = [o if isinstance(o, Column) else ascending(o) for o in order_by]
    order += [ascending(c) for c in others]
    rank = _free_name(df, "row_num")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key; rows with a NULL key are dropped.

    The survivor is the first by ``order_by`` and then by all other columns,
    ascending, NULLs last.
    """
    return _first_per_key(df.where(has_all_keys(keys)), keys, order_by)


def dedupe_if_duplicated(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column] = (),
    count_null_keys: bool = False,
    duplicates: int | None = None,
) -> DataFrame:
    """``dedupe`` when there is any duplicate; else the table as it is, NULL keys included.

    What counts as a duplicate is ``dup_profile``'s: with ``count_null_keys``
    over all rows, else over rows with every key set. One plan decides, by a
    scalar subquery; the driver never branches. Where the profile has been made
    already, its number of ``duplicates`` spares that.
    """
    if duplicates is not None:
        return dedupe(df, keys, order_by) if duplicates else df
    if count_null_keys and len(keys) > 1 and set(df.columns) == set(keys):
        return _distinct_if_duplicated(df, keys)
    profile = dup_profile(df, keys, ignore_null_keys=not count_null_keys)
    no_duplicate = profile.select("nb_doublons").scalar() == 0
    # Without duplicates, dedupe only removes the rows that have a NULL key.
    return dedupe(df, keys, order_by).unionByName(df.where(~has_all_keys(keys)).where(no_duplicate))


def _distinct_if_duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # The key is the whole row, so one aggregate by key holds both the distinct
    # rows and the number of copies; the subquery reuses its shuffle. Asking for
    # copies = 1 changes nothing (no duplicate means one copy each) and keeps
    # both sides of the plan on the same columns.
    copies = _free_name(df, "copies")
    groups = df.groupBy(*keys).agg(F.count("*").alias(copies))
    no_duplicate = groups.agg(F.sum(F.col(copies) - 1).alias("n")).scalar() == 0
    kept = groups.where(has_all_keys(keys) | ((F.col(copies) == 1) & no_duplicate))
    return kept.select(*df.columns)


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], sequence: str | Sequence[str]) -> DataFrame:
    """First row per key in the order of ``sequence``; NULL keys equal each other."""
    return _first_per_key(df, keys, [sequence] if isinstance(sequence, str) else list(sequence))
