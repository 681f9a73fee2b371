"""A pipeline from raw documents to packed training sequences, one operator per stage."""

from __future__ import annotations

from catalograph.llm.common import clear, mark, written
from catalograph.llm.stages import mix_sources, near_duplicates, pack_sequences, quality_rules, substring_duplicates

STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", substring_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Fingerprints, tokens and certified cut-offs have no SQL form; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written and read again before the next. What a stage wrote on its way
    is removed when its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    start = mark()
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        clear(spark, since=start, but_last=1)
    return STAGES[-1][1](spark, docs, sf_dir)
