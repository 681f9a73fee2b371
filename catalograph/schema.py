"""Declared schemas of the three catalog tables and column-name helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.functions import finite

MASTER = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("stock_quantity", T.IntegerType()),
    ]
)
LINK = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("id_web", T.StringType()),
    ]
)
LISTING = T.StructType(
    [
        T.StructField("id_web", T.StringType()),
        T.StructField("post_type", T.StringType()),
        T.StructField("post_title", T.StringType()),
        T.StructField("total_sales", T.DoubleType()),
    ]
)

# Table names the three workbooks are stored under.
MASTER_TABLE = "fichier_erp"
LINK_TABLE = "fichier_liaison"
LISTING_TABLE = "fichier_web"

TABLES = {MASTER_TABLE: MASTER, LINK_TABLE: LINK, LISTING_TABLE: LISTING}

KEY_COLUMNS = ("product_id", "id_web")


def rename_if_present(df: DataFrame, old: str = "sku", new: str = "id_web") -> DataFrame:
    """Rename ``old`` to ``new`` when it exists (exact spelling); else a no-op."""
    if old not in df.columns:
        return df
    if new in df.columns:
        raise ValueError(f"cannot rename {old!r}: {new!r} already exists")
    return df.toDF(*[new if c == old else c for c in df.columns])


def present_columns(df: DataFrame, wanted: Sequence[str] = KEY_COLUMNS) -> list[str]:
    """The wanted columns this frame has, in the wanted order."""
    return [c for c in wanted if c in df.columns]


def parse_cell(text: Column, dtype: T.DataType, label: str, strict: bool = True) -> Column:
    """A text cell as ``dtype``.

    Whole numbers may be spelled ``5`` or ``5.0``. A cell the type cannot hold, or a
    number that is not finite, fails the job when ``strict``, and becomes NULL otherwise.
    """
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        as_double = text.try_cast("double")
        whole = F.when(as_double == F.floor(as_double), as_double.try_cast(dtype))
        value = F.coalesce(text.try_cast(dtype), whole)
    else:
        value = text.try_cast(dtype)
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            value = finite(value)
    if not strict:
        return value
    problem = F.concat(F.lit(f"column {label}: not a {dtype.simpleString()}: "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(problem).cast(dtype)).otherwise(value)


def conform(
    df: DataFrame, schema: T.StructType, passthrough: Sequence[str] | None = None, strict: bool = True
) -> DataFrame:
    """Cast the text columns named in ``schema``; carry the others through as text.

    ``passthrough`` limits which other columns are kept (default: all of them).
    """
    declared = [parse_cell(F.col(f"`{f.name}`"), f.dataType, f.name, strict).alias(f.name) for f in schema]
    names = set(schema.fieldNames())
    rest = [c for c in df.columns if c not in names] if passthrough is None else list(passthrough)
    return df.select(*declared, *[F.col(f"`{c}`") for c in rest])
