"""The physical plans hold at scale: what is shuffled, pushed down and reused."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from catalograph.operators.dedupe import dedupe, dedupe_if_duplicated
from catalograph.operators.joins import heavy_keys, spread_join
from catalograph.operators.profile import dup_profile
from catalograph.operators.report import ranked, revenue_report
from catalograph.operators.segment import premium, price_scores, with_raw_score
from catalograph.plans import read_catalog
from catalograph.storage import row_position
from queries import views
from queries.packing import workbook_bytes, zip_bytes
from queries.views import table
from queries.work import stored

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent


def test_score_needs_no_window_and_no_join(spark):
    plan = final_plan(premium(with_raw_score(views.stored_report(spark, SF_DIR), "prix_unitaire")))
    assert "Window" not in plan and "Join" not in plan
    assert "stddev_samp" in plan and "partial_" in plan


def test_statistics_read_one_column(spark):
    plan = final_plan(price_scores(views.stored_report(spark, SF_DIR)))
    assert "ReadSchema: struct<prix_unitaire:double>" in plan


def test_dedupe_combines_before_the_shuffle(spark):
    lines = table(spark, SF_DIR, "lineitem").select("l_partkey", "l_orderkey", "l_quantity")
    plan = final_plan(dedupe(lines, ["l_partkey"]))
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_min")
    assert plan.count("Exchange") == 1


def test_dedupe_in_a_given_order_limits_rows_before_the_shuffle(spark):
    lines = table(spark, SF_DIR, "lineitem").select("l_partkey", "l_orderkey", "l_quantity")
    plan = final_plan(dedupe(lines, ["l_partkey"], [F.col("l_quantity").desc()]))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    assert plan.count("Exchange") == 1


def test_whole_row_key_is_a_hash_aggregate(spark):
    lines = table(spark, SF_DIR, "lineitem").select("l_partkey", "l_orderkey")
    plan = final_plan(dedupe(lines, ["l_partkey", "l_orderkey"]))
    assert "HashAggregate" in plan and "Window" not in plan and "Sort" not in plan
    assert "IsNotNull(l_partkey)" in plan and "IsNotNull(l_orderkey)" in plan


def test_gate_scans_and_shuffles_pairs_once(spark):
    pairs = table(spark, SF_DIR, "lineitem").select("l_partkey", "l_orderkey")
    plan = final_plan(dedupe_if_duplicated(pairs, ["l_partkey", "l_orderkey"], count_null_keys=True))
    assert "ReusedExchange" in plan
    assert plan.count("FileScan") == 1


def test_profile_combines_before_the_shuffle(spark):
    plan = final_plan(dup_profile(table(spark, SF_DIR, "lineitem"), ["l_partkey"], ignore_null_keys=True))
    scan = plan.index("FileScan")
    assert "HashAggregate" in plan[plan.rindex("Exchange", 0, scan) : scan]
    assert "ReadSchema: struct<l_partkey:bigint>" in plan


def test_each_part_reads_its_own_folder(spark):
    plan = final_plan(views.segments(spark, SF_DIR).where("segment = 'premium'"))
    assert re.search(r"PartitionFilters: \[[^\]]*segment[^\]]* = premium", plan)


def test_foreign_workbooks_are_not_parsed(spark, tmp_path):
    """A table inflates and parses its own workbooks alone: the others here are no workbooks at all."""
    book = workbook_bytes(["product_id", "price", "stock_quantity"], [[1, 2.0, 3]])
    (tmp_path / "a.zip").write_bytes(
        zip_bytes({"fichier_erp.xlsx": book, "fichier_liaison.xlsx": b"no book", "fichier_web.xlsx": b"none", "other.xlsx": b"x"})
    )
    assert rows(read_catalog(spark, str(tmp_path), rest=None).master) == [(1, 2.0, 3)]


def test_filters_reach_the_scan(spark):
    report = views.stored_report(spark, SF_DIR)
    plan = final_plan(report.where(F.col("stock") > 3).select("product_id"))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(stock,3\)", plan)


def test_stored_table_is_read_back_in_the_same_shape(spark):
    df = spark.range(5).select("id", F.lit("x").alias("s"))
    again = stored(df, "shape")
    assert again.dtypes == df.dtypes and rows(again) == rows(df)
    assert "FileScan" in final_plan(again)


def test_identical_rows_are_sorted_by_several_tasks(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions=8)
    copies = stored(spark.range(0, 20_000, 1, 8).select(F.lit(1).alias("k"), F.lit(2.0).alias("v")), "copies")
    ordered = ranked(copies, "v", row_position(copies))
    sizes = [r["n"] for r in ordered.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 10_000
    assert row_position(spark.range(3)) == []


# Heavy keys

HOT = 60_000


def skewed(spark):
    hot = spark.range(HOT).select(F.lit(7).cast("long").alias("product_id"), F.concat(F.lit("h"), "id").alias("id_web"))
    cold = spark.range(2 * HOT).select(
        (F.col("id") % 5000 + 10).alias("product_id"), F.concat(F.lit("c"), "id").alias("id_web")
    )
    nulls = spark.range(10).select(
        F.lit(None).cast("long").alias("product_id"), F.col("id").cast("string").alias("id_web")
    )
    return hot.unionByName(cold).unionByName(nulls)


def master_of(spark):
    return spark.range(6000).select(
        F.col("id").alias("product_id"),
        (F.col("id") * 1.5).alias("price"),
        F.col("id").cast("int").alias("stock_quantity"),
    )


def test_heavy_keys_are_exact_and_bounded(spark):
    assert rows(heavy_keys(skewed(spark), "product_id", 60)) == [(7, 20)]
    even = spark.range(100_000).select((F.col("id") % 50).alias("k"))
    assert [r[0] for r in rows(heavy_keys(even, "k", 100))] == sorted(range(50), key=lambda k: repr((k, 2)))
    assert rows(heavy_keys(even, "k", 20)) == []
    assert rows(heavy_keys(spark.range(0).toDF("k"), "k", 10)) == []
    # However many partitions there are, fewer keys than tasks exceed an average task.
    assert heavy_keys(spark.range(3000).toDF("k"), "k", 100_000).count() == 3000


def test_a_key_of_nine_average_tasks_is_split_at_ten_thousand_partitions(spark):
    hot = spark.range(2_000_000).select(F.when(F.col("id") < 1818, -1).otherwise(F.col("id")).alias("k"))
    assert rows(heavy_keys(hot, "k", 10_000)) == [(-1, 10)]


def spread(fact, dim, key, by):
    return spread_join(fact, dim, key, by, heavy_keys(fact, key))


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_spread_join_equals_the_plain_join(spark, conf, threshold):
    conf(spark__sql__autoBroadcastJoinThreshold=threshold, spark__sql__shuffle__partitions=16)
    fact, dim = skewed(spark), master_of(spark)
    plain = fact.join(dim, "product_id")
    found = spread(fact, dim, "product_id", F.col("id_web")).select(*plain.columns)
    assert found.count() == plain.count() == 3 * HOT
    assert found.exceptAll(plain).count() == 0


def test_spread_join_with_repeated_dim_rows_and_text_keys(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    fact = spark.range(5000).select(key.alias("k"), "id")
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("4", 3), (None, 4)], "k string, v int")
    expected = fact.join(dim, "k")
    found = spread(fact, dim, "k", F.col("id")).select(*expected.columns)
    assert found.count() == expected.count() == 2 * 1667 + 1
    assert found.exceptAll(expected).count() == 0


def test_heavy_key_is_spread_over_tasks_after_a_dedupe(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions=16,
    )
    fact, dim = skewed(spark), dedupe(master_of(spark), ["product_id"])

    def largest(df):
        return max(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())

    assert largest(fact.join(dim, "product_id")) >= HOT
    assert largest(spread(fact, dim, "product_id", F.col("id_web"))) < HOT / 2


def test_join_without_heavy_keys_keeps_the_partitioning_of_the_dedupe(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    fact = table(spark, SF_DIR, "lineitem").select(F.col("l_partkey").alias("product_id"), "l_orderkey")
    dim = dedupe(
        table(spark, SF_DIR, "part").select(F.col("p_partkey").alias("product_id"), "p_name"), ["product_id"]
    )
    plan = final_plan(spread_join(fact, dim, "product_id", F.col("l_orderkey")))
    assert plan.count("Exchange hashpartitioning") == 2


def test_salted_sides_always_agree(spark, conf):
    """Counts are exact, so both sides find the same heavy keys even when they are counted twice."""
    conf(spark__sql__execution__reuseSubquery="false", spark__sql__exchange__reuse="false")
    conf(spark__sql__shuffle__partitions=16)
    fact, dim = skewed(spark), master_of(spark)
    assert spread(fact, dim, "product_id", F.col("id_web")).count() == 3 * HOT


def test_adaptive_execution_splits_a_heavy_web_id(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions=32,
    )
    link = spark.range(3000).select(F.col("id").alias("product_id"), F.concat(F.lit("w"), "id").alias("id_web"))
    # A third of all listings carry one web id.
    listing = spark.range(0, 3 * HOT, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "w5").otherwise(F.concat(F.lit("w"), F.col("id") % 3000)).alias("id_web"),
        F.concat(F.lit("title "), "id").alias("post_title"),
        F.lit(1.0).alias("total_sales"),
    )
    report = revenue_report(dedupe(master_of(spark), ["product_id"]), dedupe(link, ["product_id", "id_web"]), listing)
    plan = final_plan(report)
    assert "skew=true" in plan
    assert report.count() == 3 * HOT


def test_library_keeps_to_dataframes():
    """No collecting, RDDs, hints without a size check, cross joins or local checkpoints."""
    banned = r"\.collect\(|\.first\(|toPandas|\.rdd\b|crossJoin|broadcast\(|localCheckpoint|\.toLocalIterator|\.limit\(|sample\("
    for path in (ROOT / "catalograph").rglob("*.py"):
        text = path.read_text()
        if "llm" in path.parts:  # its own tests say what it may do
            continue
        if path.name == "joins.py":  # the one broadcast, of fewer keys than tasks
            text = text.replace("F.broadcast(heavy)", "")
        assert not re.search(banned, text), path
