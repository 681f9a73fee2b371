"""CSV files with a header line, with declared or inferred types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.functions import missing_to_null
from catalograph.operators.inference import inferred_schema
from catalograph.schema import conform
from catalograph.sources.csv_records import SPLIT, csv_records, header_names
from catalograph.sources.ranged import Opener, open_anywhere


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None,
    passthrough: Sequence[str] | None = None,
    multiline: bool = True,
    strict: bool = True,
) -> DataFrame:
    """Comma-separated UTF-8 files, columns matched by header name.

    Missing tokens become NULL, declared columns are cast, others stay text. Without a
    ``schema`` the types are inferred from all cells (``operators.inference``), in one more pass.
    All files must share one header; a file with another one fails the job. So
    does a line with too many or too few fields, unless ``strict`` is off.

    ``multiline`` allows line breaks inside quotes, at the price of one task per
    file. Turn it off for large files known to have none, so that they are split;
    :func:`read_large_csv` splits files that have some.
    """
    raw = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .option("encoding", "UTF-8")
        .csv(path if isinstance(path, str) else list(path))
    )
    text = raw.select(*[missing_to_null(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    return conform(text, inferred_schema(text) if schema is None else schema, passthrough, strict)


def read_large_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None,
    passthrough: Sequence[str] | None = None,
    strict: bool = True,
    position: bool = False,
    split_bytes: int = SPLIT,
    work: str | None = None,
    open_file: Opener = open_anywhere,
) -> DataFrame:
    """What :func:`read_csv` gives with line breaks inside quotes, but each file is read by many tasks.

    Ranges of ``split_bytes`` are read on their own, see ``sources.csv_records`` for how and for ``work`` and
    ``open_file``. With ``position`` the columns ``_file`` and ``_position`` (first byte of the record)
    stand in front: the input order.
    """
    header, records = csv_records(spark, path, split_bytes, work, open_file)
    names = header_names(header)
    kinds = T.StructType([T.StructField(name, T.StringType()) for name in names])
    options = {"escape": '"', "mode": "FAILFAST" if strict else "PERMISSIVE", "multiLine": "true", "maxCharsPerColumn": "-1"}
    cells = F.from_csv("record", kinds.toDDL(), options).alias("cells")
    place = [F.col("path").alias("_file"), F.col("position").alias("_position")] if position else []
    raw = records.select(*place, cells).select(*[c for c in ("_file", "_position") if position], "cells.*")
    text = raw.select(*[F.col(c) for c in raw.columns[: len(place)]], *[missing_to_null(F.col(f"`{c}`")).alias(c) for c in names])
    if schema is None:
        schema = inferred_schema(text.drop("_file", "_position") if position else text)
    found = conform(text, schema, passthrough, strict)
    front = ["_file", "_position"] if position else []
    return found.select(*front, *[F.col(f"`{c}`") for c in found.columns if c not in front])
