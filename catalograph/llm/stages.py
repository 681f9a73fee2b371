"""Stages of the corpus pipeline: each calls one operator and lets its decisions take effect.

A stage takes ``(spark, docs, sf_dir)`` and returns the columns of ``docs``; only the
last returns packed pieces. Rows with nulls, repeated rows and empty tables are treated as
the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm import mixing, packing, quality, simhash, substrings

END_ID = 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.quality_rules(docs, labels).where("kept").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id."""
    return simhash.deduplicated(docs, shingle=4, radius=4)


def substring_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that a document with a smaller id has too."""
    out = substrings.remove_repeats(docs, window=13)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in mixing order, those of wanted sources up to twice."""
    return mixing.mixed(docs, mixing.word_count(F.col("text")), F.col("source"), F.col("doc_id"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids, window and place in it."""
    out = packing.pack(docs, packing.word_bpe, END_ID, carry=["doc_id"])
    return out.select("doc.doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
