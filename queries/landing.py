"""A landing folder of archives of which some lack a workbook, made by Spark from the documents."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from queries.packing import ARCHIVE_SCHEMA, zip_bytes

# Send this module's functions to the executors, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _lot(number: int, text: str) -> bytes:
    """The archive of one document: three workbooks, but for every fifth, seventh, eleventh and thirteenth."""
    if number % 13 == 4:
        return zip_bytes({"Notes.txt": text, "__MACOSX/._Fichier_ERP.xlsx": "fork"})
    files = {"Export/": "", "Export/Fichier_ERP.XLS" if number % 7 == 2 else "Export/Fichier_ERP.XLSX": text}
    if number % 5 != 1:
        files["Fichier_Web.xlsm"] = text
    files["a/fichier_liaison.xlsx"] = "1"
    if number % 11 == 3:
        files["b/Fichier_Liaison.xlsx"] = "2"
    return zip_bytes(files)


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs = batch.to_pylist()
        packed = [_lot(doc["doc_id"], doc["text"] or "") for doc in docs]
        yield pa.RecordBatch.from_pydict({"path": [f"lot-{doc['doc_id']}.zip" for doc in docs], "content": packed})


def document_lots(documents: DataFrame) -> DataFrame:
    """(path, content) of one archive per document."""
    return documents.select("doc_id", "text").mapInArrow(_lots, ARCHIVE_SCHEMA)
