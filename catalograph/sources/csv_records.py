"""CSV files of any size, read by many tasks although quoted fields may hold line breaks.

A line end is the end of a record if the number of quotes before it is even. Two passes over byte ranges
of the files say which ones are:

1. every range counts its quotes; running sums per file tell each range whether it starts inside quotes;
2. every range, knowing that, gives the records that start in it, reading on to the end of its last one.

Spark's own parser turns records into columns. In files whose first line ends in CR LF, as in Spark's own reading, CR LF
inside quotes becomes LF. A file must double the quotes inside quoted fields and have
none in others, as CSV writers do; an odd number of quotes in a file is an error.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalograph.sources.ranged import Opener, listed_files, open_anywhere
from catalograph.storage import stored

# Send this module's functions to the executors, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT = 32 << 20  # bytes of a range
CHUNK = 1 << 20  # bytes looked at at once
RECORDS = 2000  # of an Arrow batch
RANGE_SCHEMA = "path string, start long, stop long, quotes long, header string, crlf boolean"
RECORD_SCHEMA = "path string, position long, record string"
MARK = b"\xef\xbb\xbf"  # of UTF-8, before the first record of some files


def _records(file: io.BufferedIOBase, start: int, stop: int, inside: int, chunk: int) -> Iterator[tuple[int, bytes]]:
    """(position, bytes) of each record that starts in ``[start, stop)``, without its line end; ``inside`` says
    whether ``start`` lies between quotes."""
    file.seek(max(start - 1, 0))
    first = start == 0 or (file.read(1) == b"\n" and not inside)
    begin = start if first else None  # of the record that is read; None while it is another range's
    held: list[bytes] = []
    at = start
    while begin is None or begin < stop:
        # Behind the range only the rest of its last record is wanted.
        data = file.read(min(chunk, stop - at) if at < stop else min(chunk, 1 << 16))
        if not data:
            break
        marks = np.frombuffer(data, np.uint8)
        odd = (np.cumsum(marks == 34, dtype=np.uint8) + np.uint8(inside)) & 1  # modulo 256 keeps what is odd
        done = 0
        for end in np.flatnonzero((marks == 10) & (odd == 0)).tolist():
            if begin is not None:
                held.append(data[done:end])
                yield begin, b"".join(held)
                held.clear()
            done = end + 1
            begin = at + done
            if begin >= stop:
                return
        if begin is not None:
            held.append(data[done:])
        inside = int(odd[-1])
        at += len(data)
        if begin is None and at >= stop:
            return
    if begin is not None and any(held):
        yield begin, b"".join(held)


def _text(record: bytes, path: str, position: int, crlf: bool = False) -> str:
    if position == 0:
        record = record.removeprefix(MARK)
    record = record.removesuffix(b"\r")
    if crlf:
        record = record.replace(b"\r\n", b"\n")
    try:
        return record.decode("utf-8")
    except UnicodeDecodeError as error:
        raise ValueError(f"{path}: the record at byte {position} is no UTF-8: {error}") from error


def _count_quotes(open_file: Opener, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            quotes, headers, ends = [], [], []
            for row in rows:
                with open_file(row["path"]) as file:
                    file.seek(row["start"])
                    left, n = row["stop"] - row["start"], 0
                    while left > 0 and (data := file.read(min(chunk, left))):
                        n += data.count(b'"')
                        left -= len(data)
                    quotes.append(n)
                    first = next(_records(file, 0, 1, 0, 1 << 16), (0, b"")) if row["start"] == 0 else None
                    headers.append(first and _text(first[1], row["path"], 0))
                    ends.append(first and first[1].endswith(b"\r"))
            yield pa.RecordBatch.from_pydict(
                {
                    "path": [r["path"] for r in rows],
                    "start": [r["start"] for r in rows],
                    "stop": [r["stop"] for r in rows],
                    "quotes": pa.array(quotes, pa.int64()),
                    "header": pa.array(headers, pa.string()),
                    "crlf": pa.array(ends, pa.bool_()),
                }
            )

    return run


def _read_records(open_file: Opener, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rows: list[tuple[int, str]] = []

                def packed() -> pa.RecordBatch:
                    columns = [pa.array([row["path"]] * len(rows)), pa.array([p for p, _ in rows], pa.int64()), pa.array([r for _, r in rows])]
                    return pa.RecordBatch.from_arrays(columns, names=["path", "position", "record"])

                with open_file(row["path"]) as file:
                    for position, record in _records(file, row["start"], row["stop"], row["inside"], chunk):
                        if position == 0:  # the header
                            continue
                        text = _text(record, row["path"], position, row["crlf"])
                        if text:  # an empty line is no record
                            rows.append((position, text))
                        if len(rows) == RECORDS:
                            yield packed()
                            rows = []
                if rows:
                    yield packed()

    return run


def csv_records(
    spark: SparkSession,
    path: str | Sequence[str],
    split_bytes: int = SPLIT,
    work: str | None = None,
    open_file: Opener = open_anywhere,
    pattern: str = "*",
) -> tuple[str, DataFrame]:
    """The header all files share, and (path, position, record) of every record behind it.

    ``position`` is the record's first byte in its file. The counts of the ranges are stored in the shared folder
    ``work`` if it is given; else they are made again when records are read. Files without a byte are skipped.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = listed_files(spark, path, pattern).where("length > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long")))
    ranges = files.select("path", "length", starts.alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, "length").alias("stop"))
    counted = ranges.repartition(tasks, "path", "start").mapInArrow(_count_quotes(open_file, CHUNK), RANGE_SCHEMA)
    if work is not None:
        counted = stored(counted, work, "csv-ranges")
    per_file = counted.groupBy("path").agg((F.sum("quotes") % 2).alias("odd"), F.max("header").alias("header"))
    found = per_file.agg(
        F.max(F.when(F.col("odd") == 1, F.col("path"))).alias("odd"), F.min("header").alias("low"), F.max("header").alias("high"),
        F.min_by("path", "header").alias("first"), F.max_by("path", "header").alias("last"),
    ).take(1)[0]
    if found["odd"] is not None:
        raise ValueError(f"{found['odd']}: an odd number of quotes")
    if found["low"] != found["high"]:
        raise ValueError(f"{found['first']} and {found['last']} have different headers")
    # A row per range: small beside the data, whatever the file.
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before) % 2, F.lit(0)).cast("int").alias("inside")
    crlf = F.coalesce(F.max("crlf").over(Window.partitionBy("path")), F.lit(False)).alias("crlf")
    known = counted.select("path", "start", "stop", inside, crlf).repartition(tasks, "path", "start")
    return found["low"] or "", known.mapInArrow(_read_records(open_file, CHUNK), RECORD_SCHEMA)


def header_names(header: str) -> list[str]:
    """Column names of a header record: blank ones are numbered, repeated ones an error."""
    names = next(csv.reader(io.StringIO(header, newline="")), [])
    names = [name if name.strip() else f"_c{k}" for k, name in enumerate(names)]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"header with {', '.join(twice)} more than once")
    return names
