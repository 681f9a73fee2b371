"""Tables that are replaced as a whole and outlive a failed replacement.

A table is a folder. Every replacement writes a new folder ``v-<id>`` below it; when that is complete, a small commit
file with the next number names it. Readers take the version of the highest commit that is whole, so a write that dies,
or is still running, changes nothing for them. Two writers never share a number: a commit file is only ever created.
The last versions are kept, so that a query that has begun to read one can end.
"""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COMMITS = "_commits"
END = "."  # a commit that does not end in it was not written to its end
KEPT = 2


class NoVersion(LookupError):
    """A table without any committed version."""


class _Store:
    """The file system of a table's folder, as the driver sees it."""

    def __init__(self, spark: SparkSession, table: str):
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.text = spark._jvm.org.apache.commons.io.IOUtils
        self.table = table.rstrip("/")
        self.files = self.hadoop.Path(self.table).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, *names: str):
        return self.hadoop.Path("/".join((self.table, *names)))

    def names(self, *below: str) -> dict[str, int]:
        """Names in a folder and when they were changed, in milliseconds; none if there is no such folder."""
        place = self.path(*below)
        if not self.files.exists(place):
            return {}
        return {f.getPath().getName(): f.getModificationTime() for f in self.files.listStatus(place)}

    def read(self, *names: str) -> str:
        stream = self.files.open(self.path(*names))
        try:
            return self.text.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, content: str, *names: str) -> bool:
        """Write a new file; False if there is one of that name."""
        try:
            stream = self.files.create(self.path(*names), False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        try:
            stream.write(bytearray(content.encode()))
        finally:
            stream.close()
        return True

    def remove(self, *names: str) -> None:
        self.files.delete(self.path(*names), True)


def _commits(store: _Store) -> dict[int, dict]:
    """What each whole commit says, by its number."""
    found = {}
    for name in store.names(COMMITS):
        if name.isdigit():
            content = store.read(COMMITS, name)
            if content.endswith(END):
                found[int(name)] = json.loads(content.removesuffix(END))
    return found


def _newest(store: _Store) -> tuple[int, dict] | None:
    """The last whole commit, looking from the highest number down."""
    for number in sorted((int(n) for n in store.names(COMMITS) if n.isdigit()), reverse=True):
        content = store.read(COMMITS, f"{number:012d}")
        if content.endswith(END):
            return number, json.loads(content.removesuffix(END))
    return None


def replace_table(df: DataFrame, table: str, partition_by: str | None = None, keep: int = KEPT) -> str:
    """Make ``df`` the content of the table in folder ``table`` and return the new version's path.

    ``df`` may read the table itself. If writing fails the table is as before. ``keep`` versions stay, the new one
    included.
    """
    spark = df.sparkSession
    store = _Store(spark, table)
    version = f"v-{uuid.uuid4().hex}"
    path = f"{store.table}/{version}"
    try:
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(path)
    except Exception:
        store.remove(version)
        raise
    content = json.dumps({"version": version, "schema": df.schema.jsonValue()}) + END
    number = 1 + max((int(n) for n in store.names(COMMITS) if n.isdigit()), default=0)
    while not store.create(content, COMMITS, f"{number:012d}"):
        number += 1  # another writer was first
    for old in sorted(_commits(store), reverse=True)[keep:]:
        _forget(store, old)
    return path


def _forget(store: _Store, number: int) -> None:
    said = json.loads(store.read(COMMITS, f"{number:012d}").removesuffix(END))
    store.remove(COMMITS, f"{number:012d}")
    store.remove(said["version"])


def version_path(spark: SparkSession, table: str) -> str:
    """Where the table's current rows are."""
    store = _Store(spark, table)
    found = _newest(store)
    if found is None:
        raise NoVersion(f"{table} has no committed version")
    return f"{store.table}/{found[1]['version']}"


def load_version(spark: SparkSession, table: str, back: int = 0) -> DataFrame:
    """The current rows of the table in folder ``table``, or those of ``back`` versions before."""
    store = _Store(spark, table)
    commits = _commits(store) if back else dict(filter(None, [_newest(store)]))
    if len(commits) <= back:
        raise NoVersion(f"{table} has {len(commits)} committed versions")
    said = commits[sorted(commits, reverse=True)[back]]
    return spark.read.schema(T.StructType.fromJson(said["schema"])).parquet(f"{store.table}/{said['version']}")


def vacuum(spark: SparkSession, table: str, older_than_hours: float = 24.0) -> list[str]:
    """Remove what writers that died have left: folders that no commit names and broken commits, if nothing has
    changed in them for so many hours. Returns their names."""
    store = _Store(spark, table)
    commits = _commits(store)
    named = {said["version"] for said in commits.values()}
    limit = (time.time() - 3600 * older_than_hours) * 1000
    gone = [n for n, changed in store.names().items() if n.startswith("v-") and n not in named and changed <= limit]
    broken = [n for n, changed in store.names(COMMITS).items() if not (n.isdigit() and int(n) in commits) and changed <= limit]
    for name in gone:
        store.remove(name)
    for name in broken:
        store.remove(COMMITS, name)
    return sorted(gone + broken)
