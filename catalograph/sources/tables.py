"""Stored tables and temporary views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def load_table(spark: SparkSession, folder: str, name: str, schema: StructType | str | None = None) -> DataFrame:
    """The Parquet table ``name`` below ``folder``; with a ``schema``, only its columns, and nothing is inferred."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder.rstrip('/')}/{name}")


def register(df: DataFrame, name: str) -> DataFrame:
    """Give the frame a name SQL can use; returns it unchanged."""
    df.createOrReplaceTempView(name)
    return df


def list_tables(spark: SparkSession) -> DataFrame:
    """(table_name): tables and views of the current database."""
    return spark.sql("SHOW TABLES").selectExpr("tableName AS table_name")
