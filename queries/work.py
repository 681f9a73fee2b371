"""The folder in which queries keep what they read more than once."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from catalograph import storage

_own: tempfile.TemporaryDirectory | None = None


def folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Where it is unset a local session gets
    a temporary one, removed when the process ends; on a cluster that is an error."""
    global _own
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
    if _own is None:
        _own = tempfile.TemporaryDirectory(prefix="catalograph-")
    return _own.name


def stored(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    return storage.stored(df, folder(df.sparkSession), label, partition_by)


def new_path(spark: SparkSession, label: str) -> str:
    return storage.new_path(folder(spark), label)
