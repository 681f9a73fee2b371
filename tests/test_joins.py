"""Join sizes before the join, reasons of rejection, bucketed tables, figures gathered while writing."""

from __future__ import annotations

import random
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from catalograph.operators import clean
from catalograph.operators.checks import Watch
from catalograph.operators.dedupe import dedupe
from catalograph.operators.joins import FanOut, fan_out_keys, heavy_keys, join_sizes, predicted_rows, require_fan_out
from catalograph.sinks import save_bucketed, write_parquet
from queries import views

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent


def tables(spark, n=300):
    rng = random.Random(n)
    key = lambda: rng.choice([None, 1, 1, 1, *range(2, 20)])
    web = lambda: rng.choice([None, "a", "a", "b", *"cdefgh"])
    master = spark.createDataFrame([(key(), float(k)) for k in range(n)], "product_id long, price double")
    link = spark.createDataFrame([(key(), web()) for _ in range(n)], "product_id long, id_web string")
    listing = spark.createDataFrame([(web(), "t") for _ in range(n)], "id_web string, post_title string")
    return link, master, listing


def test_size_is_that_of_the_joins(spark):
    link, master, listing = tables(spark)
    sizes = join_sizes(link, master, listing)
    joined = link.join(master, "product_id").join(listing, "id_web")
    assert predicted_rows(sizes).first().rows == joined.count()
    expected = {(r.product_id, r.id_web): r["count"] for r in joined.groupBy("product_id", "id_web").count().collect()}
    assert {(r.product_id, r.id_web): r.rows for r in sizes.collect()} == expected
    links = link.join(master.select("product_id").distinct(), "product_id").join(listing.select("id_web").distinct(), "id_web").count()
    assert predicted_rows(sizes).first().links == links
    assert {(r.product_id, r.id_web) for r in fan_out_keys(sizes).collect()} == {(r.product_id, r.id_web) for r in sizes.collect() if r.rows > r.links}


def test_too_much_fan_out_is_an_error_before_the_join(spark):
    link, master, listing = tables(spark)
    sizes = join_sizes(link, master, listing)
    with pytest.raises(FanOut, match=r"links give \d+ rows, more than 1.5 each; \(1, a\): \d+ rows"):
        require_fan_out(sizes, 1.5)
    require_fan_out(sizes, 1e9)
    unique = join_sizes(dedupe(link, ["product_id", "id_web"]), dedupe(master, ["product_id"]), dedupe(listing, ["id_web"]))
    require_fan_out(unique, 1)
    assert predicted_rows(unique).first().fan_out == 0 and fan_out_keys(unique).count() == 0
    nothing = predicted_rows(join_sizes(link.limit(0), master, listing)).first()
    assert tuple(nothing) == (0, 0, 0, 0)


def test_sizes_beyond_64_bits(spark):
    counts = spark.createDataFrame([(1, "a", 10**12), (2, "b", 1)], "product_id long, id_web string, links long")
    sizes = counts.withColumn("rows", F.col("links").cast("decimal(38,0)") * F.lit(10**13).cast("decimal(14,0)"))
    assert predicted_rows(sizes.withColumn("rows", F.col("rows").cast("decimal(38,0)"))).first().rows == 10**25 + 10**13


# Reasons


def test_listing_parts_are_the_input(spark, tmp_path):
    raw = views.web(spark, SF_DIR)
    tagged = clean.with_reasons(raw, clean.listing_rules())
    kept, gone = clean.write_routed(tagged, f"{tmp_path}/web")
    assert rows(kept) == rows(clean.keep_type(clean.drop_blank_keys(raw))) == rows(clean.accepted(tagged))
    assert rows(kept.unionByName(gone.drop(clean.REASONS))) == rows(raw)
    assert rows(gone) == rows(clean.rejected(tagged))
    counts = {r.reason: r.n for r in clean.reason_counts(tagged).collect()}
    blank = raw.where("id_web IS NULL OR id_web = ''").count()
    other = raw.where("post_type <> 'product'").count()
    both = raw.where("(id_web IS NULL OR id_web = '') AND post_type <> 'product'").count()
    assert counts == {"accepted": kept.count(), "rejected": blank + other - both, "blank_key": blank, "other_type": other}
    strict = {r.reason: r.n for r in clean.reason_counts(clean.with_reasons(raw, clean.listing_rules(strict_type=True))).collect()}
    assert strict["other_type"] == raw.count() - raw.where("post_type = 'product'").count()
    plan = final_plan(clean.accepted(tagged))
    assert plan.count("Scan") == 1 and "Exchange" not in plan


def test_keys(spark):
    raw = spark.createDataFrame([(1, 2.0), (1, 1.0), (1, None), (None, 1.0), (None, 1.0), (2, 5.0), (2, 5.0)], "k long, v double")
    ranked, rules = clean.key_rules(raw, ["k"])
    tagged = clean.with_reasons(ranked, rules).drop("_place")
    assert rows(clean.accepted(tagged)) == rows(dedupe(raw, ["k"]))
    assert sorted((r.k or 0, tuple(r[clean.REASONS])) for r in clean.rejected(tagged).collect()) == [
        (0, ("null_key",)), (0, ("null_key",)), (1, ("duplicate",)), (1, ("duplicate",)), (2, ("duplicate",)),
    ]
    assert {r.reason: r.n for r in clean.reason_counts(clean.with_reasons(raw.limit(0), {})).collect()} == {}


# Bucketed tables


def bucketed(spark, conf, tmp_path, names):
    conf(spark__sql__autoBroadcastJoinThreshold=-1)
    link = views.hot_link(spark, SF_DIR)
    master = views.erp_d(spark, SF_DIR)
    heavy = heavy_keys(link, "product_id", tasks=8)
    left = save_bucketed(link, names[0], f"{tmp_path}/link", "product_id", 8, heavy, F.col("id_web"))
    right = save_bucketed(master, names[1], f"{tmp_path}/master", "product_id", 8, heavy)
    return link, master, left, right


def test_bucketed_tables_join_without_an_exchange(spark, conf, tmp_path):
    names = ("bucketed_link", "bucketed_master")
    try:
        link, master, left, right = bucketed(spark, conf, tmp_path, names)
        joined = left.join(right, ["product_id", "_part"]).drop("_part")
        plan = final_plan(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows(joined) == rows(link.join(master, "product_id").select(*joined.columns))
        assert "Exchange hashpartitioning" not in final_plan(left.groupBy("product_id", "_part").agg(F.count("*").alias("n")))
        parts = [r.n for r in left.groupBy("product_id", "_part").agg(F.count("*").alias("n")).collect()]
        assert max(parts) < left.count() / 4  # the hot product holds a third
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bucketed_table_without_heavy_keys(spark, tmp_path):
    try:
        df = save_bucketed(spark.range(100).withColumn("v", F.col("id") % 3), "bucketed_plain", f"{tmp_path}/t", "id", 4)
        assert df.columns == ["id", "v"] and df.count() == 100
    finally:
        spark.sql("DROP TABLE IF EXISTS bucketed_plain")


# Figures gathered while writing


def test_figures_of_writes(spark, tmp_path):
    watch = Watch()
    df = spark.range(10).withColumn("v", F.when(F.col("id") > 3, F.col("id")))
    write_parquet(watch.on(df, "first", rows=F.count("*"), values=F.count("v"), total=F.sum("v")), f"{tmp_path}/a")
    write_parquet(watch.on(df.limit(0), "none", rows=F.count("*"), total=F.sum("v")), f"{tmp_path}/b")
    assert rows(watch.rows(spark)) == [("first", "rows", 10.0), ("first", "total", 39.0), ("first", "values", 6.0), ("none", "rows", 0.0), ("none", "total", None)]


def test_tasks_that_are_tried_again_count_once(tmp_path):
    script = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from catalograph.operators.checks import Watch
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate()
@F.udf("long")
def fails_first(x):
    if x % 25 == 24 and TaskContext.get().attemptNumber() < 2:
        raise ValueError("lost")
    return x
watch = Watch()
df = spark.range(0, 100, 1, 4).select(fails_first("id").alias("id"))
watch.on(df, "s", rows=F.count("*"), total=F.sum("id")).write.parquet({str(tmp_path / "out")!r})
print("figures", sorted(watch.figures().items()))
"""
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "figures [(('s', 'rows'), 100.0), (('s', 'total'), 4950.0)]" in run.stdout, run.stderr[-2000:]
