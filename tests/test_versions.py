"""Tables outlive failed replacements."""

from __future__ import annotations

import json
import threading

import pytest
from conftest import rows
from pyspark.sql import functions as F

from catalograph.sinks import drop_table, save_table
from catalograph.versions import COMMITS, NoVersion, load_version, replace_table, vacuum, version_path


def broken(spark, n=1000):
    """Rows of which the last task's fail while they are written."""
    return spark.range(0, n, 1, 4).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("task lost")).cast("long")).otherwise(F.col("id")).alias("id"))


def test_readers_see_the_last_whole_version(spark, tmp_path):
    table = f"{tmp_path}/t"
    with pytest.raises(NoVersion):
        load_version(spark, table)
    replace_table(spark.range(3), table)
    old = load_version(spark, table)
    replace_table(spark.range(5).select("id", F.lit("x").alias("s")), table)
    assert rows(old) == [(0,), (1,), (2,)]  # still there for who reads it
    assert load_version(spark, table).dtypes == [("id", "bigint"), ("s", "string")] and load_version(spark, table).count() == 5
    assert load_version(spark, table, back=1).count() == 3
    replace_table(load_version(spark, table).where("id > 1"), table)  # reads the table itself
    assert load_version(spark, table).count() == 3
    assert sorted(p.name for p in (tmp_path / "t" / COMMITS).iterdir() if p.suffix != ".crc") == ["000000000002", "000000000003"]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")]) == 2
    with pytest.raises(NoVersion):
        load_version(spark, table, back=2)


def test_a_write_that_dies_changes_nothing(spark, tmp_path):
    table = f"{tmp_path}/t"
    replace_table(spark.range(3), table)
    before = version_path(spark, table)
    with pytest.raises(Exception, match="task lost"):
        replace_table(broken(spark), table)
    assert version_path(spark, table) == before and rows(load_version(spark, table)) == [(0,), (1,), (2,)]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")]) == 1


def test_a_driver_that_dies_changes_nothing(spark, tmp_path):
    """Between the write and its commit, and in the midst of the commit."""
    table = tmp_path / "t"
    replace_table(spark.range(3), str(table))
    spark.range(9).write.parquet(f"{table}/v-orphan")
    content = json.dumps({"version": "v-orphan", "schema": spark.range(9).schema.jsonValue()})
    (table / COMMITS / "000000000002").write_text(content)  # its end is missing
    assert load_version(spark, str(table)).count() == 3
    assert vacuum(spark, str(table)) == []
    replace_table(spark.range(4), str(table))
    assert load_version(spark, str(table)).count() == 4 and load_version(spark, str(table), back=1).count() == 3
    assert vacuum(spark, str(table), older_than_hours=0) == ["000000000002", "v-orphan"]
    assert load_version(spark, str(table)).count() == 4 and load_version(spark, str(table), back=1).count() == 3


def test_two_writers(spark, tmp_path):
    table = f"{tmp_path}/t"
    threads = [threading.Thread(target=replace_table, args=(spark.range(n), table), kwargs={"keep": 9}) for n in (10, 20, 30, 40)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(load_version(spark, table, back=k).count() for k in range(4)) == [10, 20, 30, 40]


def test_partitions(spark, tmp_path):
    table = f"{tmp_path}/t"
    replace_table(spark.range(4).withColumn("p", F.col("id") % 2), table, partition_by="p")
    assert sorted(rows(load_version(spark, table))) == [(k, k % 2) for k in range(4)]


def test_catalog_tables_outlive_a_failed_replacement(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS versions_test LOCATION '{tmp_path}/db'")
    try:
        name = "versions_test.t"
        assert rows(save_table(spark.range(3), name)) == [(0,), (1,), (2,)]
        with pytest.raises(Exception, match="task lost"):
            save_table(broken(spark), name)
        assert rows(spark.table(name)) == [(0,), (1,), (2,)]
        assert save_table(spark.range(7), name).count() == spark.table(name).count() == 7
        assert save_table(spark.range(2).select(F.col("id").cast("string").alias("s")), name).dtypes == [("s", "string")]
        spark.range(1).write.saveAsTable("versions_test.managed")  # one that Spark made
        assert save_table(spark.range(6), "versions_test.managed").count() == 6
        drop_table(spark, name)
        assert not spark.catalog.tableExists(name) and not (tmp_path / "db" / "t.versions").exists()
    finally:
        spark.sql("DROP DATABASE versions_test CASCADE")
