"""Readers: archives, workbooks inside them, CSV files, stored tables."""

from catalograph.sources.archives import GAPS, archive_entries, archive_gaps, archive_index, is_readable, read_archives, read_entries
from catalograph.sources.csv_files import read_csv, read_large_csv
from catalograph.sources.csv_records import csv_records
from catalograph.sources.ranged import list_anywhere, listed_files, open_anywhere
from catalograph.sources.tables import list_tables, load_table, register
from catalograph.sources.workbooks import SUFFIXES, workbook_columns, workbook_rows, workbook_table

__all__ = [
    "GAPS",
    "SUFFIXES",
    "archive_entries",
    "archive_gaps",
    "archive_index",
    "csv_records",
    "is_readable",
    "list_anywhere",
    "list_tables",
    "listed_files",
    "load_table",
    "open_anywhere",
    "read_archives",
    "read_csv",
    "read_entries",
    "read_large_csv",
    "register",
    "workbook_columns",
    "workbook_rows",
    "workbook_table",
]
