"""Helpers shared by the operators: shared storage, words, empty results."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.storage import remove

# The six white-space characters that part words: U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


_own: tempfile.TemporaryDirectory | None = None
_made: list[str] = []  # folders written by this process, in order


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    A local session without that setting gets a temporary folder, removed when the process ends; a
    cluster without it is an error, because a local folder of the driver is not seen by the executors.
    """
    global _own
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _own is None:
        _own = tempfile.TemporaryDirectory(prefix="catalograph-llm-")
    return _own.name


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder in the shared one that nobody uses yet; :func:`clear` removes it."""
    _made.append(f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}")
    return _made[-1]


def mark() -> int:
    """How many folders this process has taken so far."""
    return len(_made)


def clear(spark: SparkSession, since: int = 0, but_last: int = 0) -> None:
    """Remove the folders taken after ``since`` (:func:`mark`), but for the last ones. Only results that
    have been written elsewhere stay readable."""
    upto = max(since, len(_made) - but_last)
    for path in _made[since:upto]:
        remove(spark, path)
    del _made[since:upto]


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: it is
    computed once, and a lost executor costs a re-read, not the lineage."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores put before it until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def trim() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if give is not None:
        give(0)


def tidy(work):
    """A task's generator that, when it ends, gives freed memory back to the system: Spark
    keeps the worker process for later tasks, whose memory it would add to."""

    @functools.wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            trim()

    return run
