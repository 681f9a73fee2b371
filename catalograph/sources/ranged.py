"""Files read by byte range from tasks, and Spark's listing of them."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator, Sequence
from fnmatch import fnmatchcase
from itertools import islice
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Send this module's functions to the executors, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Opener = Callable[[str], BinaryIO]
Lister = Callable[[str], Iterator[tuple[str, int]]]
BATCH_ROWS = 8192  # of a listing


def _store(path: str):
    """Arrow's file system for a path with a scheme, and the name there."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    scheme = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")


def open_anywhere(path: str) -> BinaryIO:
    """A file that can seek, by the path that Spark lists it under: on shared disks, or in a store
    that Arrow's file systems reach (S3, GCS, HDFS, Azure)."""
    scheme, colon, rest = path.partition(":")
    if path.startswith("/") or not colon:
        return open(path, "rb")
    if scheme == "file":  # such paths are not escaped
        return open("/" + rest.lstrip("/"), "rb")
    store, name = _store(path)
    return store.open_input_file(name)


def _hidden(name: str) -> bool:
    """Do Spark's readers pass over a file or folder of this name?"""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def list_anywhere(path: str) -> Iterator[tuple[str, int]]:
    """(path, length) of every file below a folder, wherever ``open_anywhere`` opens files. As with Spark's readers,
    hidden files and files without a byte are left out."""
    scheme, colon, rest = path.partition(":")
    if path.startswith("/") or not colon or scheme == "file":
        folders = ["/" + rest.strip("/") if scheme == "file" else os.path.abspath(path)]
        while folders:
            with os.scandir(folders.pop()) as found:
                for item in found:
                    if _hidden(item.name):
                        continue
                    if item.is_dir():
                        folders.append(item.path)
                    elif length := item.stat().st_size:
                        yield "file:" + item.path, length
        return
    from pyarrow import fs

    store, top = _store(path)
    top = top.rstrip("/")
    for item in store.get_file_info(fs.FileSelector(top, recursive=True)):
        below = item.path[len(top) :]
        if item.is_file and item.size and not any(_hidden(name) for name in below.split("/")):
            yield path.rstrip("/") + below, item.size


def _listed(list_folder: Lister, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                found = (f for f in list_folder(folder) if fnmatchcase(f[0].rpartition("/")[2], pattern))
                while some := list(islice(found, BATCH_ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), (pa.string(), pa.int64()))], names=["path", "length"])

    return run


def listed_files(spark: SparkSession, path: str | Sequence[str], pattern: str, list_folder: Lister | None = None) -> DataFrame:
    """(path, length) of every file below ``path`` whose name fits ``pattern``; no content is read.

    ``list_folder`` lists a folder in a task, so that each of many folders in ``path`` is listed by itself and the
    driver holds no file's name; None leaves listing to Spark, which does it for any store, on the driver. Spark
    counts 4 MB for opening a file, which is not done here, and so gives a task about 30 files; such tasks are
    joined to as many as a shuffle has.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = [path] if isinstance(path, str) else list(path)
    if list_folder is not None:
        folders = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks, "path")
        return folders.mapInArrow(_listed(list_folder, pattern), "path string, length long").repartition(tasks, "path")
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return reader.load(paths).select("path", "length").coalesce(tasks)
