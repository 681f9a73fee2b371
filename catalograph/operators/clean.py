"""Row filters on keys and types, and the reasons for which they remove rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalograph.functions import has_all_keys, is_blank
from catalograph.schema import KEY_COLUMNS, present_columns


def drop_blank_keys(df: DataFrame, columns: Sequence[str] = ("id_web",)) -> DataFrame:
    """Remove rows where any of the columns is NULL or ``''`` (``' '`` stays)."""
    for c in columns:
        df = df.where(~is_blank(F.col(c)))
    return df


def keep_type(
    df: DataFrame, column: str = "post_type", value: str = "product", keep_null: bool = True
) -> DataFrame:
    """Keep rows of one type; rows without a type stay only if ``keep_null``."""
    wanted = F.col(column) == value
    return df.where(wanted | F.col(column).isNull() if keep_null else wanted)


def drop_null_keys(df: DataFrame, wanted: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Remove rows with a NULL in any wanted key column the frame has."""
    keys = present_columns(df, wanted)
    return df.where(has_all_keys(keys)) if keys else df


REASONS = "_reasons"
ACCEPTED = "_accepted"


def with_reasons(df: DataFrame, rules: Mapping[str, Column], name: str = REASONS) -> DataFrame:
    """Add the names of all rules that reject a row, in the order given; an empty list accepts it.

    A rule is a condition that rejects where it is true; where it is NULL it does not. One pass tells all
    reasons, so a row that breaks two rules counts for both.
    """
    broken = [F.when(F.coalesce(condition, F.lit(False)), F.lit(rule)) for rule, condition in rules.items()]
    return df.withColumn(name, F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>"))


def listing_rules(strict_type: bool = False, value: str = "product") -> dict[str, Column]:
    """Why a listing row is rejected: what ``drop_blank_keys`` and ``keep_type`` remove."""
    kind = F.col("post_type")
    other = ~F.equal_null(kind, F.lit(value)) if strict_type else kind != value
    return {"blank_key": is_blank(F.col("id_web")), "other_type": other}


def key_rules(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with a helper column, and why ``dedupe`` by ``keys`` would remove a row: a NULL key, or not the first.

    The first row is ``dedupe``'s survivor: by ``order_by``, then by all other columns, NULLs last. Rows of one key
    are ranked together, after rows with NULL keys were dealt to groups of their own.
    """
    others = [c for c in df.columns if c not in keys and c not in order_by]
    ordered = [F.col(f"`{c}`").asc_nulls_last() for c in (*order_by, *others)] or [F.lit(0)]
    whole = has_all_keys(list(keys))
    # A NULL key has no first row: its rows are spread, not gathered.
    alone = F.when(~whole, F.monotonically_increasing_id())
    ranked = df.withColumn("_alone", alone)
    window = Window.partitionBy(*keys, "_alone").orderBy(*ordered)
    ranked = ranked.withColumn("_place", F.row_number().over(window)).drop("_alone")
    return ranked, {"null_key": ~whole, "duplicate": whole & (F.col("_place") > 1)}


def accepted(tagged: DataFrame, name: str = REASONS) -> DataFrame:
    """The rows without a reason, in their own columns."""
    return tagged.where(F.size(name) == 0).drop(name)


def rejected(tagged: DataFrame, name: str = REASONS) -> DataFrame:
    """The rows with a reason, reasons included."""
    return tagged.where(F.size(name) > 0)


def reason_counts(tagged: DataFrame, name: str = REASONS) -> DataFrame:
    """(reason, n): how many rows every reason rejects; ``accepted`` counts the others, ``rejected`` all rejected."""
    none = F.size(name) == 0
    told = F.concat(F.when(none, F.array(F.lit("accepted"))).otherwise(F.array(F.lit("rejected"))), F.col(name))
    return tagged.select(F.explode(told).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def write_routed(tagged: DataFrame, path: str, name: str = REASONS) -> tuple[DataFrame, DataFrame]:
    """Write all rows in one pass, accepted and rejected ones in folders of their own, and read both back.

    Cleaning thus needs one scan and loses no row: the two parts are the input.
    """
    tagged.withColumn(ACCEPTED, F.size(name) == 0).write.partitionBy(ACCEPTED).parquet(path)
    read = tagged.sparkSession.read.schema(tagged.schema.add(ACCEPTED, "boolean")).parquet(path)
    return read.where(F.col(ACCEPTED)).drop(ACCEPTED, name), read.where(~F.col(ACCEPTED)).drop(ACCEPTED)
