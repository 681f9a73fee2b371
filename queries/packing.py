"""Archives and workbooks made by Spark from table rows, as input for the readers."""

from __future__ import annotations

import io
import os
import sys
import uuid
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Send this module's functions to the executors, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The parts every workbook needs.
MAIN_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE_NS = "http://schemas.openxmlformats.org/package/2006"
CONTENT_TYPES = f'<Types xmlns="{PACKAGE_NS}/content-types"/>'
WORKBOOK = (
    f'<workbook {MAIN_NS} xmlns:r="{REL_NS}"><sheets>'
    '<sheet name="Data" sheetId="1" r:id="rId1"/></sheets></workbook>'
)
WORKBOOK_RELS = (
    f'<Relationships xmlns="{PACKAGE_NS}/relationships">'
    f'<Relationship Id="rId1" Type="{REL_NS}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>'
)


def _letters(column: int) -> str:
    out = ""
    while column >= 0:
        out = chr(ord("A") + column % 26) + out
        column = column // 26 - 1
    return out


def workbook_bytes(header: Sequence[str], rows: Iterable[Sequence]) -> bytes:
    """A minimal workbook: text cells shared on even rows and inline on odd ones, None left out."""
    strings: dict[str, int] = {}
    lines = []
    for number, row in enumerate([header, *rows], start=1):
        cells = []
        for i, value in enumerate(row):
            at = f"{_letters(i)}{number}"
            if value is None:
                continue
            if not isinstance(value, str):
                cells.append(f'<c r="{at}"><v>{value!r}</v></c>')
            elif number % 2:
                text = f'<t xml:space="preserve">{escape(value)}</t>'
                cells.append(f'<c r="{at}" t="inlineStr"><is>{text}</is></c>')
            else:
                cells.append(f'<c r="{at}" t="s"><v>{strings.setdefault(value, len(strings))}</v></c>')
        lines.append(f'<row r="{number}">{"".join(cells)}</row>')
    items = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings)
    return zip_bytes(
        {
            "[Content_Types].xml": CONTENT_TYPES,
            "xl/workbook.xml": WORKBOOK,
            "xl/_rels/workbook.xml.rels": WORKBOOK_RELS,
            "xl/sharedStrings.xml": f"<sst {MAIN_NS}>{items}</sst>",
            "xl/worksheets/sheet1.xml": f'<worksheet {MAIN_NS}><sheetData>{"".join(lines)}</sheetData></worksheet>',
        }
    )


def zip_bytes(files: dict[str, str | bytes]) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in files.items():
            archive.writestr(zipfile.ZipInfo(name), content, zipfile.ZIP_DEFLATED)
    return buffer.getvalue()


ARCHIVE_SCHEMA = "path string, content binary"


def _zip_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = batch.to_pylist()
        packed = [
            zip_bytes({"Textes/": "", f"Textes/{doc['lang']}/Corps.v1.TXT": doc["text"], "Source.CSV": doc["source"]})
            for doc in docs
        ]
        yield pa.RecordBatch.from_pydict({"path": [f"doc-{doc['doc_id']}.zip" for doc in docs], "content": packed})


def document_archives(documents: DataFrame) -> DataFrame:
    """One archive per document: its text, its source and an empty folder."""
    return documents.select("doc_id", "lang", "text", "source").mapInArrow(_zip_document, ARCHIVE_SCHEMA)


def _zip_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        books = {}
        for name, columns in TABLE_COLUMNS.items():
            header = ["sku" if (c, name) == ("id_web", "Fichier_Web") else c for c in columns]
            own = [[row[c] for c in columns] for row in rows if row["book"] == name]
            for i, values in enumerate(own):
                if i % 2 and isinstance(values[0], int):  # half of the whole numbers spelled as 5.0
                    values[0] = float(values[0])
            books[f"Export/{name}.XLSX"] = workbook_bytes(header, own)
        packed = zip_bytes(books)
        yield pa.RecordBatch.from_pydict({"path": [f"lot-{zlib.crc32(packed):08x}.zip"], "content": [packed]})


TABLE_COLUMNS = {
    "Fichier_ERP": ["product_id", "price", "stock_quantity"],
    "Fichier_Liaison": ["product_id", "id_web"],
    "Fichier_Web": ["id_web", "post_type", "post_title", "total_sales"],
}


def table_archives(tables: Sequence[DataFrame]) -> DataFrame:
    """Archives of three workbooks each, one archive per Arrow batch of rows.

    Batches have a bounded number of rows, so no archive grows with the data.
    """
    rows = None
    for (name, columns), df in zip(TABLE_COLUMNS.items(), tables):
        part = df.select(F.lit(name).alias("book"), *columns)
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    return rows.mapInArrow(_zip_tables, ARCHIVE_SCHEMA)


def archive_folders(folder: str, folders: int) -> list[str]:
    """The folders to which ``archive_files`` deals archives."""
    return [folder] if folders == 1 else [f"{folder}/{k:03x}" for k in range(folders)]


def archive_files(archives: DataFrame, folder: str, folders: int = 1) -> str:
    """Write archives as files below ``folder``, which every executor must see under this path.

    Spark reads binary files but has no writer for them. A file is renamed when it is
    complete, so a task that runs again replaces it. Tasks that make files in one folder wait for each
    other, so many files go to several ``folders`` below, each to the one that its name gives.
    """
    scheme, _, path = folder.rpartition("://")
    if scheme not in ("", "file"):
        raise ValueError(f"archives are written by path; {folder} is none")

    places = archive_folders(path, folders)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place in places:
            os.makedirs(place, exist_ok=True)
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                place = places[zlib.crc32(name.encode()) % folders]
                part = f"{place}/.{name}.{uuid.uuid4().hex}"
                with open(part, "wb") as out:
                    out.write(content)
                os.replace(part, f"{place}/{name}")
        yield pa.RecordBatch.from_pydict({"n": pa.array([1], pa.int32())})

    archives.mapInArrow(save, "n int").count()
    return folder
