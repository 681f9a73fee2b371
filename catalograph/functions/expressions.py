"""Built-in column expressions; no UDF here."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that count as missing when a text file or a workbook
# is read (the documented pandas defaults).
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def missing_to_null(text: Column) -> Column:
    """NULL for a cell whose whole text is one of the missing tokens."""
    return F.when(~text.isin(*MISSING_TOKENS), text)


def has_all_keys(keys: Sequence[str]) -> Column:
    """True when no key column is NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def is_blank(column: Column) -> Column:
    """NULL or the empty string; a space is not blank. Never NULL itself."""
    return column.isNull() | (column == "")


def finite(number: Column) -> Column:
    """The number, or NULL when it is NaN or infinite."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def round_to(column: Column, digits: int) -> Column:
    """Round the scaled double half away from zero, then scale back.

    ``round(1.005 * 100) / 100`` is 1.0, as SQL engines that round binary
    doubles answer; ``F.round(1.005, 2)`` goes through the decimal text and
    answers 1.01.
    """
    scale = float(10**digits)
    return F.round(column * F.lit(scale)) / F.lit(scale)


def revenue(price: Column, sales: Column) -> Column:
    """Price times units sold, no sale counting as zero, to the cent."""
    return round_to(price * F.coalesce(sales, F.lit(0.0)), 2)


def thousands(amount: Column) -> Column:
    """``1234567.5`` as ``1,234,567.50``."""
    return F.format_number(amount, 2)


def table_name_of(entry: Column) -> Column:
    """Table name of a file path: base name without its last extension, lower case."""
    return F.lower(F.regexp_replace(entry, r"^.*/|(?<=[^/])\.[^./]*$", ""))
