"""Large CSV files: ranges, records, inferred types and the one ordered file."""

from __future__ import annotations

import datetime
import io
import random

import pandas as pd
import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from catalograph.operators.inference import inferred_schema, inferred_types
from catalograph.operators.report import ranked
from catalograph.schema import LINK, LISTING
from catalograph.sinks import write_csv, write_one_csv
from catalograph.sources import csv_records, read_csv, read_large_csv
from catalograph.sources.csv_records import _records
from catalograph.storage import numbered

CELLS = ["a", "", '"q, ""x"""', '"l1\nl2"', '"\n"', '"""\n"""', '"a\r\nb"', "é", '"é\n,ü"', " ", '""']


def plain(data: bytes) -> list[tuple[int, bytes]]:
    """Records by going through the bytes one by one."""
    out, begin, inside = [], 0, False
    for k, byte in enumerate(data):
        inside ^= byte == 34
        if byte == 10 and not inside:
            out.append((begin, data[begin:k]))
            begin = k + 1
    return out + ([(begin, data[begin:])] if begin < len(data) else [])


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_ranges_give_every_record_once(chunk):
    rng = random.Random(chunk)
    for _ in range(60):
        lines = [",".join(rng.choices(CELLS, k=3)) for _ in range(rng.randint(0, 12))]
        data = rng.choice(["\n", "\r\n"]).join(lines).encode() + rng.choice([b"", b"\n", b"\n\n"])
        size = rng.randint(1, 40)
        found = []
        for start in range(0, len(data), size):
            inside = data[:start].count(b'"') % 2
            found += _records(io.BytesIO(data), start, min(start + size, len(data)), inside, chunk)
        assert found == plain(data), data


def big_file(tmp_path, n=3000, end="\n"):
    rng = random.Random(1)
    path = tmp_path / "web.csv"
    lines = ["post_type,extra,id_web,total_sales,post_title"]
    for k in range(n):
        lines.append(f'{rng.choice(["product", "NA", "attachment"])},{rng.choice(CELLS)},w{k},{rng.choice(["5.0", "", "7"])},{rng.choice(CELLS)}')
    path.write_bytes(end.join(lines).encode() + b"\n\n")
    return path


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_by_many_tasks_is_read_alike(spark, tmp_path, end):
    path = big_file(tmp_path, end=end)
    whole = read_csv(spark, str(path), LISTING)
    large = read_large_csv(spark, str(path), LISTING, split_bytes=4000, work=f"{tmp_path}/work")
    assert large.dtypes == whole.dtypes and rows(large) == rows(whole) and large.count() == 3000
    ids = large.select(F.spark_partition_id().alias("p")).distinct().count()
    assert ids == 4  # all tasks of this session
    assert [r.id_web for r in read_large_csv(spark, str(path), LISTING, position=True, split_bytes=999).orderBy("_file", "_position").collect()] == [f"w{k}" for k in range(3000)]


def test_bytes_are_not_shuffled(spark, tmp_path):
    plan = final_plan(read_large_csv(spark, str(big_file(tmp_path, 50)), LISTING, split_bytes=500, work=f"{tmp_path}/work"))
    assert "record" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


@pytest.mark.parametrize("line", ["1,a,extra", "1"])
def test_line_with_another_number_of_fields(spark, tmp_path, line):
    (tmp_path / "a.csv").write_text(f"product_id,id_web\n2,b\n{line}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_large_csv(spark, str(tmp_path), LINK).collect()
    assert rows(read_large_csv(spark, str(tmp_path), LINK, strict=False)) == rows(read_csv(spark, str(tmp_path), LINK, strict=False))


def test_refused_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("product_id,id_web\n1,a\n")
    (tmp_path / "b.csv").write_text("id_web,product_id\nb,2\n")
    with pytest.raises(ValueError, match="a.csv and .*b.csv have different headers|b.csv and .*a.csv have different headers"):
        read_large_csv(spark, str(tmp_path), LINK)
    (tmp_path / "b.csv").write_text('product_id,id_web\n1,"a\n')
    with pytest.raises(ValueError, match="b.csv: an odd number of quotes"):
        read_large_csv(spark, str(tmp_path), LINK)
    (tmp_path / "b.csv").write_bytes(b"product_id,id_web\n1,\xff\n")
    with pytest.raises(Exception, match="b.csv: the record at byte 18 is no UTF-8"):
        read_large_csv(spark, str(tmp_path), LINK).collect()
    (tmp_path / "b.csv").write_text("product_id,product_id\n1,2\n")
    with pytest.raises(ValueError, match="product_id more than once"):
        read_large_csv(spark, str(tmp_path / "b.csv"), LINK)


def test_marks_empty_files_and_missing_line_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfproduct_id,id_web\n1,a")
    (tmp_path / "b.csv").write_bytes(b"product_id,id_web\r\n2,b\r\n\r\n3,c\r\n")
    (tmp_path / "c.csv").write_bytes(b"")
    (tmp_path / "d.csv").write_bytes(b"product_id,id_web")
    assert rows(read_large_csv(spark, str(tmp_path), LINK)) == [(1, "a"), (2, "b"), (3, "c")]


def test_numbers_follow_files_and_positions(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text("product_id,id_web\n" + "".join(f"{k},{'x' * (j % 7)}{k}-{j}\n" for j in range(40)))
    df = read_large_csv(spark, str(tmp_path), LINK, position=True, split_bytes=100)
    found = numbered(df, "_file", "_position", width=64).orderBy("row_number").collect()
    assert [r.row_number for r in found] == list(range(1, 121))
    assert [r.id_web.lstrip("x") for r in found] == [f"{k}-{j}" for k in range(3) for j in range(40)]


# Types


def test_types_of_all_cells(spark):
    columns = {
        "whole": ["1", "-2", "+3", None],
        "number": ["1", "2.5", ".5", "-1e3"],
        "mixed": ["1", "2.5", "x", None],
        "day": ["2024-02-29", None, "1999-12-31", None],
        "no_day": ["2023-02-29", None, "1999-12-31", None],
        "nothing": [None] * 4,
        "too_large": ["9223372036854775808", "1", None, None],
        "endless": ["1e999", "1", None, None],
        "spaced": [" 1", "2", "3", "4"],
        "day_or_number": ["2024-02-28", "1", None, None],
        "blank": ["", "1", "2", "3"],
    }
    text = spark.createDataFrame([*zip(*columns.values())], ", ".join(f"{c} string" for c in columns)).repartition(3)
    found = {r.column: (r.type, r.n_values, r.n_missing) for r in inferred_types(text).collect()}
    kinds = dict(zip(columns, ["bigint", "double", "string", "date", "string", "missing", "double", "string", "string", "string", "string"]))
    assert found == {c: (kinds[c], sum(v is not None for v in columns[c]), sum(v is None for v in columns[c])) for c in columns}
    assert final_plan(inferred_types(text)).count("Exchange") <= 2
    assert inferred_schema(text)["whole"].dataType.simpleString() == "bigint"
    assert {r.type for r in inferred_types(text.limit(0)).collect()} == {"missing"}


@pytest.mark.parametrize("read", [read_csv, read_large_csv])
def test_csv_without_a_schema(spark, tmp_path, read):
    (tmp_path / "a.csv").write_text('id,price,day,name,none\n1,5,2024-01-31,"a\nb",\n2,NA,,7,null\n3,2.5,2024-02-01,,\n')
    df = read(spark, str(tmp_path), None)
    assert df.dtypes == [("id", "bigint"), ("price", "double"), ("day", "date"), ("name", "string"), ("none", "string")]
    day = datetime.date(2024, 1, 31)
    assert rows(df)[0] == (1, 5.0, day, "a\nb", None) and rows(df)[1] == (2, None, None, "7", None)


# One ordered file


def test_one_file_holds_all_rows_in_order(spark, tmp_path):
    data = [(k, f"n{k % 7}", 'say "x",\n y' if k % 5 else None, float(k * 7919 % 1000) if k % 11 else None) for k in range(2000)]
    df = spark.createDataFrame(data, "id long, name string, title string, amount double").repartition(5)
    path = str(tmp_path / "report.csv")
    assert write_one_csv(ranked(df, "amount"), path) == path
    frame = pd.read_csv(path)
    expected = sorted(data, key=lambda r: (r[3] is None, -(r[3] or 0), r[0]))
    assert [r[0] for r in frame.itertuples(index=False)] == [r[0] for r in expected]
    assert list(frame.columns) == df.columns and (tmp_path / "report.csv").read_bytes().count(b"id,name") == 1
    parts = read_csv(spark, write_csv(ranked(df, "amount"), f"{tmp_path}/parts"), df.schema)
    assert rows(read_large_csv(spark, path, df.schema, split_bytes=3000)) == rows(parts)
    assert [p.name for p in tmp_path.iterdir() if "report" in p.name] == ["report.csv"]


def test_one_file_replaces_and_a_failure_keeps_the_old_one(spark, tmp_path):
    path = str(tmp_path / "a, b.csv")
    write_one_csv(spark.range(3).toDF("n, x"), path)
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise("x").alias("n"))
    with pytest.raises(Exception, match="no"):
        write_one_csv(broken, path)
    assert (tmp_path / "a, b.csv").read_text() == '"n, x"\n0\n1\n2\n'
    assert [p.name for p in tmp_path.iterdir()] == ["a, b.csv"]
    write_one_csv(spark.range(0).toDF("n"), "file://" + path)
    assert (tmp_path / "a, b.csv").read_text() == "n\n"
