"""First sheet of .xlsx workbooks as rows of named text cells."""

from __future__ import annotations

import posixpath
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.functions import missing_to_null
from catalograph.schema import parse_cell

# Send this module's functions to the executors, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROW_SCHEMA = "archive string, entry string, table_name string, row_idx long, cells map<string,string>"
ROWS_PER_BATCH = 2000
SUFFIXES = (".xlsx", ".xlsm")

# Fixed values of the workbook format: XML namespaces and the built-in number
# formats that show a date or a time.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
ROW, CELL, VALUE, ITEM, TEXT = (MAIN + tag for tag in ("row", "c", "v", "si", "t"))
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])


def _xml(book: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _first_sheet(book: zipfile.ZipFile) -> tuple[str, datetime]:
    """Path of the first sheet, and the day its date numbers count from."""
    workbook = _xml(book, "xl/workbook.xml")
    links = _xml(book, "xl/_rels/workbook.xml.rels")
    path, epoch = "xl/worksheets/sheet1.xml", datetime(1899, 12, 30)
    if workbook is not None:
        settings = workbook.find(f"{MAIN}workbookPr")
        if settings is not None and settings.get("date1904") in ("1", "true"):
            epoch = datetime(1904, 1, 1)
        sheet = workbook.find(f"{MAIN}sheets/{MAIN}sheet")
        if sheet is not None and links is not None:
            for link in links:
                if link.get("Id") == sheet.get(f"{REL}id"):
                    path = posixpath.normpath(posixpath.join("/xl", link.get("Target"))).lstrip("/")
    return path, epoch


def _text(node: ElementTree.Element) -> str:
    """Text of a string item: its own and its runs', without phonetic hints."""
    if len(node) == 1 and node[0].tag == TEXT:
        return node[0].text or ""
    runs = [node.find(TEXT), *(r.find(TEXT) for r in node.findall(f"{MAIN}r"))]
    return "".join(t.text or "" for t in runs if t is not None)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    strings = []
    with book.open("xl/sharedStrings.xml") as items:
        for _, node in ElementTree.iterparse(items):
            if node.tag == ITEM:
                strings.append(_text(node))
                node.clear()
    return strings


def _date_styles(book: zipfile.ZipFile) -> set[str]:
    """Cell styles that show their number as a date."""
    styles = _xml(book, "xl/styles.xml")
    if styles is None:
        return set()
    dates = {str(n) for n in DATE_FORMATS}
    for fmt in styles.findall(f"{MAIN}numFmts/{MAIN}numFmt"):
        shown = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", fmt.get("formatCode", "")).split(";")[0]
        if re.search("[dmyhs]", shown, re.IGNORECASE):
            dates.add(fmt.get("numFmtId"))
    formats = styles.findall(f"{MAIN}cellXfs/{MAIN}xf")
    return {str(i) for i, xf in enumerate(formats) if xf.get("numFmtId") in dates}


def _number(text: str) -> str:
    value = float(text)
    if not value.is_integer():
        return repr(value)
    return str(int(text)) if re.fullmatch(r"-?\d+", text) else str(int(value))


def _cell(cell: ElementTree.Element, strings: list[str], date_styles: set[str], epoch: datetime) -> str | None:
    kind, value = cell.get("t", "n"), cell.findtext(VALUE)
    if kind == "inlineStr":
        inline = cell.find(f"{MAIN}is")
        return None if inline is None else _text(inline)
    if value is None or kind == "e":  # no value, or an error such as a division by zero
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind != "n":
        return value
    if cell.get("s") in date_styles:
        return (epoch + timedelta(seconds=round(float(value) * 86400))).isoformat(" ")
    return _number(value)


def _column(letters: str) -> int:
    """Zero-based column of ``A``, ``B`` … ``AB`` …"""
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def _sheet_rows(content: pa.Buffer) -> Iterator[list[str | None]]:
    """Rows of the first sheet from row 1 to the last row holding a value, blank ones included."""
    with zipfile.ZipFile(pa.BufferReader(content)) as book:
        path, epoch = _first_sheet(book)
        strings = _shared_strings(book)
        date_styles = _date_styles(book)
        columns: dict[str, int] = {}
        done = 0
        with book.open(path) as sheet:
            for _, node in ElementTree.iterparse(sheet):
                if node.tag != ROW:
                    continue
                number = int(node.get("r", done + 1))
                row: list[str | None] = []
                for cell in node:
                    if cell.tag != CELL:
                        continue
                    letters = cell.get("r", "").rstrip("0123456789")
                    if letters:
                        at = columns.get(letters)
                        if at is None:
                            at = columns[letters] = _column(letters)
                        row.extend([None] * (at - len(row)))
                    row.append(_cell(cell, strings, date_styles, epoch))
                node.clear()
                if any(v is not None for v in row):
                    for _ in range(done + 1, number):
                        yield []
                    yield row
                    done = number


def _header(row: list[str | None]) -> list[str]:
    """Column names: blanks get a numbered name, repeats a numbered suffix."""
    names: list[str] = []
    seen: dict[str, int] = {}
    for i, cell in enumerate(row):
        name = f"Unnamed: {i}" if cell in (None, "") else cell
        if name in seen:
            base = name
            while name in seen:
                seen[base] += 1
                name = f"{base}.{seen[base]}"
        seen[name] = 0
        names.append(name)
    return names


def _named_errors(lines: Iterator[list[str | None]], source: str) -> Iterator[list[str | None]]:
    try:
        yield from lines
    except Exception as error:
        raise ValueError(f"{source}: {type(error).__name__}: {error}") from error


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()))
    names = ["archive", "entry", "table_name", "row_idx", "cells"]

    def packed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        for archive, entry, table_name, content in zip(*(batch.column(c) for c in [*names[:3], "content"])):
            source = (archive.as_py(), entry.as_py(), table_name.as_py())
            lines = _named_errors(_sheet_rows(content.as_buffer()), f"{archive}: {entry}")
            header = _header(next(lines, []))
            for i, line in enumerate(lines):
                header += [f"Unnamed: {n}" for n in range(len(header), len(line))]
                rows.append((*source, i, list(zip(header, line + [None] * (len(header) - len(line))))))
                if len(rows) == ROWS_PER_BATCH:
                    yield packed()
                    rows = []
    if rows:
        yield packed()


def workbook_rows(entries: DataFrame, spread: bool = True) -> DataFrame:
    """(archive, entry, table_name, row_idx, cells) of each workbook among archive entries.

    Row 1 is the header; ``cells`` maps every header name to the cell's text, or
    NULL. ``row_idx`` counts data rows from 0 in sheet order.

    Entries are spread by name first, so the workbooks of one large archive are
    parsed by many tasks. The number of tasks is given, as adaptive execution
    would merge them by size, and a megabyte of workbook takes seconds to parse.
    The file format holds at most 1,048,576 rows per sheet, which bounds what one
    task parses at a time. ``spread=False`` is for entries that are spread already (``read_entries``).
    """
    tasks = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_book = F.lower("entry").rlike(r"\.xls[xm]$")
    books = entries.where(is_book)
    if spread:
        books = books.repartition(tasks, "archive", "entry")
    rows = books.select("archive", "entry", "table_name", "content").mapInArrow(_parse, ROW_SCHEMA)
    return rows.withColumn("cells", F.transform_values("cells", lambda _, v: missing_to_null(v)))


def workbook_table(
    rows: DataFrame,
    table_name: str,
    schema: T.StructType,
    passthrough: Sequence[str] = (),
    rest: str | None = None,
    renames: dict[str, str] | None = None,
    strict: bool = True,
) -> DataFrame:
    """One table out of ``workbook_rows``: declared columns cast, ``passthrough`` ones as text.

    ``rest`` names a map column for the cells of all other headers, so that
    columns nobody declared are carried through too. ``renames`` (default
    ``sku`` to ``id_web``) applies to sheets that have the old name; a sheet with
    both names fails the job. ``archive``, ``entry`` and ``row_idx`` are kept, in
    this order, in front.
    """
    old_names = {new: old for old, new in (renames or {"sku": "id_web"}).items()}

    def cell(name: str):
        own = F.col("cells")[name]
        old = old_names.get(name)
        if old is None:
            return own
        both = F.map_contains_key("cells", old) & F.map_contains_key("cells", name)
        clash = F.raise_error(F.concat(F.lit(f"both {old} and {name} in "), F.col("entry"))).cast("string")
        return F.when(both, clash).otherwise(F.coalesce(F.col("cells")[old], own))

    columns = [parse_cell(cell(f.name), f.dataType, f.name, strict).alias(f.name) for f in schema]
    columns += [cell(name).alias(name) for name in passthrough]
    if rest is not None:
        used = {*schema.fieldNames(), *passthrough}
        used |= {old for new, old in old_names.items() if new in used}
        columns.append(F.map_filter("cells", lambda name, _: ~name.isin(*used)).alias(rest))
    return rows.where(F.col("table_name") == table_name).select("archive", "entry", "row_idx", *columns)


def workbook_columns(rows: DataFrame) -> DataFrame:
    """(table_name, column, sheets): every header name and how many sheets have it."""
    headers = rows.select("table_name", "archive", "entry", F.explode(F.map_keys("cells")).alias("column")).distinct()
    return headers.groupBy("table_name", "column").agg(F.count("*").alias("sheets"))
