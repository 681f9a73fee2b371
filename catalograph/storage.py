"""Write a result once to shared storage and go on from the written table.

The folder is always the caller's: one that the driver and all executors share.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def new_path(folder: str, label: str) -> str:
    """A path below ``folder`` that nobody uses yet."""
    if not folder:
        raise ValueError("no folder given that all executors share")
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below ``folder`` and read it back.

    For a result that is read more than once: its joins run once, later reads
    prune columns and partitions, and a lost executor costs a re-read rather than
    the lineage. Every call takes a new folder; :func:`remove` clears it.
    """
    path = new_path(folder, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder of a run, wherever Spark can write; False if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def row_position(df: DataFrame) -> list[Column]:
    """A sort key telling apart identical rows of a table read from Parquet files.

    A hash of file and row number: fixed by the files, so a retried task sees
    the same value. Empty for a plan that reads no files directly.
    """
    try:
        df.select("_metadata.row_index")
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            raise
        return []
    return [F.xxhash64("_metadata.file_path", "_metadata.row_index")]


def numbered(df: DataFrame, file: str, position: str, name: str = "row_number", width: int = 1 << 20) -> DataFrame:
    """Add the rows' numbers, from 1, in the order of their files and byte positions.

    Positions are cut into stretches of ``width`` bytes. A stretch is numbered by itself and starts behind the
    rows of all stretches before it, so no task sees more than a stretch, or a number per stretch of one file
    and per file. ``df`` is read twice, so pass a stored table rather than a long plan.
    """
    piece, own, files, before, file_rows = (f"_{name}_{x}" for x in ("piece", "own", "files", "before", "rows"))
    placed = df.withColumn(piece, F.floor(F.col(position) / width))
    counts = placed.groupBy(file, piece).agg(F.count("*").alias(file_rows))
    earlier = Window.partitionBy(file).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(file_rows).over(earlier), F.lit(0)))
    per_file = counts.groupBy(file).agg(F.sum(file_rows).alias(file_rows))
    # One row a file, in the order of their names.
    earlier = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    per_file = per_file.select(file, F.coalesce(F.sum(file_rows).over(earlier), F.lit(0)).alias(files))
    starts = counts.select(file, piece, before).join(per_file, file)
    within = F.row_number().over(Window.partitionBy(file, piece).orderBy(position))
    out = placed.withColumn(own, within).join(starts, [file, piece])
    number = F.col(files) + F.col(before) + F.col(own)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], number.cast("long").alias(name))
