"""ZIP archives as a DataFrame of entries.

Two ways lead there. ``archive_index`` reads only the archives' directories and says where entries
are; ``read_entries`` then reads the chosen ones by byte range, each once, wherever files can be opened
by path. ``read_archives`` and ``archive_entries`` take whole archives from Spark's own reader, for
stores that only Spark can reach.
"""

from __future__ import annotations

import sys
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.functions import table_name_of
from catalograph.sources.ranged import Opener, open_anywhere

# Send this module's functions to the executors, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_BYTES = 16 << 20
BATCH_ROWS = 8192  # of an index
MOST_BYTES = 1 << 30  # of one entry, inflated
ENTRY_SCHEMA = "archive string, entry string, content binary"
INDEX_SCHEMA = "archive string, entry string, at long, packed long, size long, method int, crc long"
LOCAL_HEADER = 30  # fixed bytes before an entry's name, extra field and data
GAPS = ("missing", "format")  # problems that leave a table without rows of an archive


def read_archives(spark: SparkSession, path: str | Sequence[str], pattern: str = "*.zip") -> DataFrame:
    """(path, content) of every archive below ``path``.

    The scan packs archives into splits of ``spark.sql.files.maxPartitionBytes``
    and spreads them over the cluster. An archive beyond Spark's 2 GB limit for
    one binary value fails the job.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return reader.load(path if isinstance(path, str) else list(path)).select("path", "content")


def _wanted(entry: str, stems: frozenset[str] | None, suffixes: tuple[str, ...]) -> bool:
    """Is this a file of the data, not one that an operating or office system left beside it?"""
    folder, _, name = entry.rpartition("/")
    if not name or "__MACOSX" in folder.split("/") or name.startswith(("._", "~$")):
        return False
    if not name.lower().endswith(suffixes):
        return False
    dot = name.rfind(".")
    return stems is None or (name[:dot] if dot > 0 else name).lower() in stems


def _expand(stems: frozenset[str] | None, suffixes: tuple[str, ...], most: int, inflate: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, str, bytes | None]] = []
        held = 0

        def packed() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, names=["archive", "entry", "content"])

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                    for info in archive.infolist():
                        if not _wanted(info.filename, stems, suffixes):
                            continue
                        if inflate and info.file_size > most:
                            raise ValueError(f"{path}: {info.filename} has {info.file_size} bytes, more than {most}")
                        # Small entries share a batch; memory holds few bytes beyond one large entry.
                        if rows and held + info.file_size > BATCH_BYTES:
                            yield packed()
                            rows, held = [], 0
                        rows.append((path.as_py(), info.filename, archive.read(info) if inflate else None))
                        held += info.file_size
        if rows:
            yield packed()

    return run


def archive_entries(
    archives: DataFrame,
    tables: Sequence[str] | None = None,
    suffixes: Sequence[str] = ("",),
    most_bytes: int = MOST_BYTES,
    content: bool = True,
) -> DataFrame:
    """(archive, entry, table_name, content): one row per file in each archive.

    ``archives`` has columns ``path`` and ``content``. Only entries of the given
    ``tables`` (all) and name ``suffixes`` (any) are inflated; resource forks
    (``__MACOSX/``, ``._name``) and lock files (``~$name``) never are. An entry of more
    than ``most_bytes`` fails the job before it is inflated. Without ``content`` the
    entries are only listed.
    """
    stems = None if tables is None else frozenset(tables)
    expand = _expand(stems, tuple(s.lower() for s in suffixes), most_bytes, content)
    entries = archives.select("path", "content").mapInArrow(expand, ENTRY_SCHEMA)
    out = entries.select("archive", "entry", table_name_of(F.col("entry")).alias("table_name"), "content")
    return out if content else out.drop("content")


# Entries by byte range


def _directories(open_file: Opener):
    def packed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
        names = ["archive", "entry", "at", "packed", "size", "method", "crc"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_file(path) as file:
                    try:
                        with zipfile.ZipFile(file) as archive:
                            found = [i for i in archive.infolist() if _wanted(i.filename, None, ("",))]
                    except zipfile.BadZipFile as error:
                        raise ValueError(f"{path}: no zip archive: {error}") from error
                if any(i.flag_bits & 1 for i in found):
                    raise ValueError(f"{path}: entries are encrypted")
                own = [(path, i.filename, i.header_offset, i.compress_size, i.file_size, i.compress_type, i.CRC) for i in found]
                # An archive without a file is listed too.
                rows.extend(own or [(path, *[None] * 6)])
                # Small archives share a batch: one batch each costs more than reading a directory.
                if len(rows) >= BATCH_ROWS:
                    yield packed(rows)
                    rows = []
        if rows:
            yield packed(rows)

    return run


def archive_index(files: DataFrame, open_file: Opener = open_anywhere) -> DataFrame:
    """(archive, entry, table_name, at, packed, size, method, crc): where each file of each archive is.

    ``files`` has the archives' ``path``. A task reads the end of an archive, where its directory is,
    and no entry. Resource forks and lock files are left out. An archive without any file has
    one row without an entry. The tasks that list archives read their directories; rows are dealt by archive.
    """
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = files.select("path").mapInArrow(_directories(open_file), INDEX_SCHEMA).repartition(tasks, "archive")
    name = F.when(F.col("entry").isNotNull(), table_name_of(F.col("entry"))).alias("table_name")
    return rows.select("archive", "entry", name, "at", "packed", "size", "method", "crc")


def _inflated(raw: bytes, method: int, size: int, crc: int) -> bytes:
    if method == zipfile.ZIP_STORED:
        content = raw
    elif method == zipfile.ZIP_DEFLATED:
        # One byte more than promised, so that an entry that says too little does not fill the memory.
        content = zlib.decompressobj(-zlib.MAX_WBITS).decompress(raw, size + 1)
    else:
        raise ValueError(f"packed by method {method}, which is not read")
    if len(content) != size or zlib.crc32(content) != crc:
        raise ValueError("its content is not what the directory says")
    return content


def _contents(open_file: Opener, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["archive", "entry", "table_name", "content"]
        types = (pa.string(), pa.string(), pa.string(), pa.binary())
        rows: list[tuple[str, str, str, bytes]] = []
        held = 0
        for batch in batches:
            for row in batch.to_pylist():
                source = f"{row['archive']}: {row['entry']}"
                if row["size"] > most:
                    raise ValueError(f"{source} has {row['size']} bytes, more than {most}")
                if rows and held + row["size"] > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows, held = [], 0
                with open_file(row["archive"]) as file:
                    file.seek(row["at"])
                    head = file.read(LOCAL_HEADER)
                    file.seek(int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"), 1)
                    raw = file.read(row["packed"])
                try:
                    content = _inflated(raw, row["method"], row["size"], row["crc"])
                except (ValueError, zlib.error) as error:
                    raise ValueError(f"{source}: {error}") from error
                rows.append((row["archive"], row["entry"], row["table_name"], content))
                held += row["size"]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def read_entries(index: DataFrame, open_file: Opener = open_anywhere, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(archive, entry, table_name, content) of the entries that ``index`` (rows of ``archive_index``) names.

    The places of entries, not their bytes, are spread over the tasks; a task reads one range per
    entry, so an archive may be of any size. An entry of more than ``most_bytes`` fails the job before
    it is read.
    """
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chosen = index.where(F.col("entry").isNotNull()).repartition(tasks, "archive", "entry")
    schema = "archive string, entry string, table_name string, content binary"
    return chosen.mapInArrow(_contents(open_file, most_bytes), schema)


def is_readable(entry: Column, suffixes: Sequence[str]) -> Column:
    """Does the entry's name end in one of the suffixes, in any case?"""
    return reduce(lambda a, b: a | b, [F.lower(entry).endswith(s.lower()) for s in suffixes])


def archive_gaps(index: DataFrame, tables: Sequence[str], suffixes: Sequence[str]) -> DataFrame:
    """(archive, table_name, problem, entries, other): what is not as expected, per archive and table.

    Every archive is expected to hold one readable entry per table. ``problem`` is ``missing``, or ``format``
    if only an entry with another suffix has the table's name (``other`` names it), or ``several``; ``entries`` counts the
    readable ones. ``index`` has a row per entry, and one without an entry for archives that hold nothing.
    One aggregate by archive: no pair of archive and table is built before it is known.
    """
    readable = F.coalesce(is_readable(F.col("entry"), suffixes), F.lit(False))
    own = {t: F.coalesce(F.col("table_name") == t, F.lit(False)) for t in tables}
    counts = [
        F.struct(
            F.lit(t).alias("table_name"),
            F.count_if(mine & readable).alias("entries"),
            F.min(F.when(mine & ~readable, F.col("entry"))).alias("other"),
        )
        for t, mine in own.items()
    ]
    found = index.groupBy("archive").agg(F.array(*counts).alias("found")).select("archive", F.inline("found"))
    nothing = F.when(F.col("other").isNull(), "missing").otherwise("format")
    problem = F.when(F.col("entries") == 0, nothing).when(F.col("entries") > 1, "several")
    named = F.when(F.col("entries") == 0, F.col("other")).alias("other")
    return found.select("archive", "table_name", problem.alias("problem"), "entries", named).where("problem IS NOT NULL")
