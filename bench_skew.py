"""Time the revenue report on large skewed tables derived from ``lineitem`` and ``part``.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_COPIES  how often the rows are repeated under new keys (default 30: 18 M links at sf0.1)

A third of the links belong to one product. Prints one JSON line with the seconds of the plain
and of the spread join.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from catalograph.operators.dedupe import dedupe
from catalograph.operators.joins import heavy_keys
from catalograph.operators.report import revenue_report
from catalograph.session import local_session
from catalograph.storage import stored


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("BENCH_COPIES", "30"))
    spark = local_session(shuffle_partitions=64, spark__driver__memory="8g", spark__sql__autoBroadcastJoinThreshold="-1")
    times = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", times)
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_retailprice", "p_size", times)
    line = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * copies + F.col("copy")
    product = F.when(line % 3 == 0, F.lit(7).cast("long")).otherwise(F.col("l_partkey") * copies + F.col("copy"))
    with tempfile.TemporaryDirectory() as folder:
        link = stored(lines.select(product.alias("product_id"), line.cast("string").alias("id_web")), folder, "link")
        listing = stored(lines.select(line.cast("string").alias("id_web"), F.lit("t").alias("post_title"), F.col("l_quantity").alias("total_sales")), folder, "listing")
        key = F.col("p_partkey") * copies + F.col("copy")
        master = stored(parts.select(key.alias("product_id"), F.col("p_retailprice").alias("price"), F.col("p_size").alias("stock_quantity")), folder, "master")
        result = {"links": link.count()}
        for name, heavy in (("plain", None), ("spread", heavy_keys(link, "product_id"))):
            start = time.perf_counter()
            revenue_report(dedupe(master, ["product_id"]), link, listing, heavy).write.format("noop").mode("overwrite").save()
            result[f"{name}_seconds"] = round(time.perf_counter() - start, 1)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
