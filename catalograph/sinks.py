"""Writers. Every sink writes in parallel, into a directory or, part by part, into one file."""

from __future__ import annotations

import csv
import io
import os
import sys
import uuid
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

from catalograph.operators.joins import parted
from catalograph.storage import remove
from catalograph.versions import replace_table

# Send this module's functions to the executors, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_FILE = 1_000_000
COPIED = 8 << 20  # bytes copied at once


def _csv_options(writer: DataFrameWriter) -> DataFrameWriter:
    # Quotes doubled, NULL as an empty field, spaces kept: what CSV readers
    # without Spark's own conventions expect.
    return (
        writer.option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", "UTF-8")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
    )


def write_csv(df: DataFrame, path: str) -> str:
    """Replace the CSV directory ``path``; file order follows the frame's order."""
    _csv_options(df.write.mode("overwrite")).csv(path)
    return path


def _local(path: str) -> str:
    return "/" + path[5:].lstrip("/") if path.startswith("file:") else path


def _copy_parts(target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open(_local(row["part"]), "rb") as part, open(target, "r+b") as out:
                    out.seek(row["at"])
                    while data := part.read(COPIED):
                        out.write(data)
            yield batch

    return run


def write_one_csv(df: DataFrame, path: str) -> str:
    """Replace the single CSV file ``path``: one header, then the rows in the frame's order.

    The parts are written in parallel as by :func:`write_csv`, then put together in storage: on shared disks every
    part is copied to its place in the file by a task of its own, elsewhere the store joins them if it can
    (HDFS does). No task sees more than a part, and the file appears under its name when it is whole.
    """
    spark = df.sparkSession
    own = uuid.uuid4().hex
    parts, made = f"{path}.parts-{own}", f"{path}.making-{own}"
    try:
        _csv_options(df.write).option("header", False).csv(parts)
        hadoop = spark._jvm.org.apache.hadoop.fs
        store = hadoop.Path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
        files = [(f.getPath(), f.getLen()) for f in store.listStatus(hadoop.Path(parts)) if f.getPath().getName().startswith("part-")]
        # Parts are numbered in the order of the rows, files of a part behind the last hyphen.
        place = lambda name: (int(name.split("-")[1]), int(name.split(".")[0].rsplit("-c", 1)[1]))
        files = sorted((f for f in files if f[1]), key=lambda f: place(f[0].getName()))
        line = io.StringIO()
        csv.writer(line, lineterminator="\n").writerow(df.columns)
        head = line.getvalue().encode()
        if store.getScheme() == "file":
            target = _local(made)
            with open(target, "wb") as out:
                out.write(head)
                out.truncate(len(head) + sum(size for _, size in files))
            starts = accumulate((size for _, size in files), initial=len(head))
            copies = [(f.toString(), at) for (f, _), at in zip(files, starts)]
            if copies:
                todo = spark.createDataFrame(copies, "part string, at long").repartition(len(copies), "at")
                todo.mapInArrow(_copy_parts(target), "part string, at long").count()
            os.replace(target, _local(path))
            return path
        out = store.create(hadoop.Path(made), False)
        out.write(bytearray(head))
        out.close()
        if files:
            try:
                store.concat(hadoop.Path(made), [f for f, _ in files])
            except Exception as error:
                raise ValueError(f"{path}: its store cannot join files; use write_csv") from error
        store.delete(hadoop.Path(path), False)
        store.rename(hadoop.Path(made), hadoop.Path(path))
        return path
    finally:
        remove(spark, parts)
        remove(spark, made)


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Replace the Parquet directory ``path``, one folder per value of ``partition_by`` if given.

    ``df`` must not read ``path`` itself.
    """
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return path


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Create or replace the catalog table ``name`` and return it.

    The rows are written and committed as a new version (:mod:`catalograph.versions`) in a folder beside the database's
    tables; only then the catalog is pointed to them. A failed write leaves the table as it is, and the version
    before is kept for queries that still read it.
    """
    spark = df.sparkSession
    database, _, own = name.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    place = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    path = replace_table(df, f"{place}/{own}.versions")
    full = f"{database}.{own}"
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    if spark.catalog.tableExists(full):
        same = [(f.name, f.dataType) for f in spark.table(full).schema] == [(f.name, f.dataType) for f in nullable]
        kind = spark.catalog.getTable(full).tableType
        if same and kind == "EXTERNAL":
            spark.sql(f"ALTER TABLE `{database}`.`{own}` SET LOCATION '{path}'")
            spark.catalog.refreshTable(full)
            return spark.table(full)
        spark.sql(f"DROP TABLE `{database}`.`{own}`")  # the rows are in their folders
    spark.catalog.createTable(full, path=path, source="parquet", schema=nullable)
    return spark.table(full)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table that :func:`save_table` made, with all its versions."""
    database, _, own = name.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    place = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{own}`")
    remove(spark, f"{place}/{own}.versions")


PART = "_part"


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, heavy: DataFrame | None = None, spread_by: Column | None = None) -> DataFrame:
    """A table stored in ``buckets`` by ``key``, sorted by it, so that joins and aggregates by the key need no exchange.

    ``heavy`` (:func:`~catalograph.operators.joins.heavy_keys` of the larger table) names keys with more rows than a task
    should hold. In the larger table their rows are parted by a hash of ``spread_by``; in the other one (no ``spread_by``) they are repeated
    once per part. The part is a column, ``_part``, and tables are bucketed by key and part: join them by both.
    """
    keys = [key]
    if heavy is not None:
        df = parted(df, key, heavy, spread_by, PART)
        keys.append(PART)
    # One task per bucket, so that a bucket is one file.
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
