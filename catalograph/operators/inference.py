"""Column types inferred from all cells of a text table, in one pass.

Types form a lattice: a whole number is a number is a text, a day is a text, and a column without any value
has no type. For every type its cells are counted; the type of a column is the lowest that all its values
have. Counts add up, so the result does not depend on how the rows are dealt to tasks, and nothing is
sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings of values; what is not spelled so is a text, even where a cast would take it.
WHOLE = r"^[+-]?[0-9]{1,19}$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TYPES = {"bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType(), "string": T.StringType(), "missing": T.StringType()}


def _is(cell: Column, spelling: str, kind: str) -> Column:
    value = cell.try_cast(kind)
    fits = F.abs(value) < F.lit(float("inf")) if kind == "double" else value.isNotNull()
    # The cast is asked only where the spelling fits.
    return F.when(cell.rlike(spelling), fits).otherwise(False)


def inferred_types(text: DataFrame) -> DataFrame:
    """(column, type, n_values, n_missing) of every column of a table of texts, NULL being missing.

    ``type`` is ``bigint``, ``double``, ``date``, ``string`` or ``missing``.
    """
    counts = []
    for name in text.columns:
        cell = F.col(f"`{name}`")
        n = F.count(cell)
        kind = (
            F.when(n == 0, "missing")
            .when(F.count_if(_is(cell, WHOLE, "bigint")) == n, "bigint")
            .when(F.count_if(_is(cell, NUMBER, "double")) == n, "double")
            .when(F.count_if(_is(cell, DAY, "date")) == n, "date")
            .otherwise("string")
        )
        fields = (F.lit(name).alias("column"), kind.alias("type"), n.alias("n_values"), (F.count("*") - n).alias("n_missing"))
        counts.append(F.struct(*fields))
    return text.agg(F.array(*counts).alias("found")).select(F.inline("found"))


def inferred_schema(text: DataFrame) -> T.StructType:
    """The inferred types as a schema; runs one job, whose result has a row per column."""
    found = {r["column"]: r["type"] for r in inferred_types(text).take(len(text.columns))}
    return T.StructType([T.StructField(name, TYPES[found[name]]) for name in text.columns])
