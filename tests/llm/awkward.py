"""Fixtures: documents that every operator must take, and small helpers."""

from __future__ import annotations

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, doc string, key string, print string"

PASSAGE = " ".join(f"word{k}" for k in range(30))


def awkward_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows; columns whose names clash."""
    rows = [
        (0, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "en", "a"),
        (1, None, "en", "a"),
        (2, "", None, "b"),
        (3, " \t\n\x0b\x0c\r ", "de", None),
        (4, PASSAGE + "\ntail of four", "en", "b"),
        (5, "head of five\n" + PASSAGE, None, None),
        (5, "head of five\n" + PASSAGE, None, None),
        (None, PASSAGE, "en", "a"),
        (None, None, None, None),
        (7, "ein langer Text " * 4000, "de", "c"),
        (8, "Größe Ñandú été  x y 東京 🎉 &amp; <b>", "fr", "c"),
        (9, "### %%% ### %%% ### ###", "en", "a"),
        (10, "same text", "en", "a"),
        (11, "same text", "en", "a"),
    ]
    return [(*r, None, 7, "x", None, "y") for r in rows]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
