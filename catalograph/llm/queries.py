"""Registered queries of the operators over the test tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.llm import alignment, langid, mixing, negatives, neighbours, oracles, packing, quality, sharding, simhash, substrings, tokens, topk, wrappers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARD_BYTES = 4_000_000
END_ID = 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    known = docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    model = langid.train(known, F.col("text"), F.col("lang"), F.col("doc_id"))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = simhash.near_duplicates(docs, shingle=4, radius=4, carry=False)
    return out.select("doc.doc_id", simhash.hex_digits(F.col("print")).alias("fingerprint"), "component_id")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = tokens.token_counts(docs, carry=["doc_id"])
    return out.select("doc.doc_id", "section", "start", "end", "n_tokens", "doc_tokens")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substrings.remove_repeats(docs, window=13, spacing=False)
    return out.select("doc.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.with_counts(docs, F.col("text")).withColumn("doc", F.struct("doc.doc_id"))
    scored = quality.written(scored, "quality-counts")
    out = quality.judged(scored, _table(spark, sf_dir, "labels"))
    return out.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    plan = mixing.mix_plan(sized, F.col("size"), F.col("source"), F.col("doc_id"))
    return plan.select("doc.doc_id", "size", "source_size", "target", "taken")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = packing.pack(docs, packing.word_bpe, END_ID, carry=["doc_id"])
    return out.select("doc.doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    rows = rows.select(F.col("vec_id").alias("id"), topk.whole_vector(F.col("embedding")).alias("vector"))
    out = topk.top_k(rows, F.col("id") % 50 == 0, k=5)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", F.octet_length("text").cast("long").alias("n"))
    out = sharding.shard(sized, F.col("doc_id"), F.col("n"), SHARD_BYTES)
    return out.select("doc.doc_id", "n_bytes", "shard", "depth", "shard_bytes", "oversized")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    text = F.col("main_text").alias("text")
    return wrappers.extract(pages).select("page_id", "url", text, F.length("main_text").cast("long").alias("n_chars"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select(F.col("vec_id").alias("id"), topk.whole_vector(F.col("embedding")).alias("vector"), moved.alias("label"))
    return negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = alignment.aligned(docs, carry=["doc_id"], keep_groups=False)
    return out.select("doc.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    part = F.crc32(F.col("doc_id").cast("string")) % 5
    labels = _table(spark, sf_dir, "labels").where(part != 0).select("doc_id", F.col("quality").alias("label"))
    out = neighbours.classified(docs, neighbours.train(docs, labels, "doc_id"), carry=["doc_id"])
    held_out = F.coalesce(part == 0, F.lit(False)).alias("held_out")
    return out.select("doc.doc_id", "score").select("doc_id", held_out, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


for _query in (
    op1_language_id,
    op2_simhash_near_dedup,
    op3_token_counts,
    op4_substring_dedup,
    op5_quality_rules,
    op6_mix_sources,
    op7_packing,
    op8_exact_top_k,
    op9_sharding,
    op10_html_extraction,
    op11_hard_negatives,
    op12_cross_tokenizer_alignment,
    op13_quality_classifier,
):
    QUERIES[_query.__name__] = _query

ORACLES.update(
    op4_substring_dedup=oracles.SUBSTRING_DEDUP,
    op5_quality_rules=oracles.quality_sql(),
    op6_mix_sources=oracles.MIX_SOURCES,
    op8_exact_top_k=oracles.EXACT_TOP_K,
    op9_sharding=oracles.sharding_sql(SHARD_BYTES),
    op11_hard_negatives=oracles.HARD_NEGATIVES,
)
