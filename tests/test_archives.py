"""Archives read by byte range: what is read, what is missing, what is refused."""

from __future__ import annotations

import io
import re
import zipfile

import pyarrow as pa
import pytest
from conftest import final_plan, rows

from catalograph.plans import IncompleteArchives, read_catalog
from catalograph.schema import TABLES
from catalograph.sources import SUFFIXES, archive_entries, archive_gaps, archive_index, list_anywhere, listed_files, read_archives, read_entries
from catalograph.sources.archives import _directories
from catalograph.sources.ranged import open_anywhere
from queries.catalog import QUERIES
from queries.packing import archive_files, archive_folders, workbook_bytes, zip_bytes


def books(lot: int = 0, n: int = 1) -> dict[str, bytes]:
    return {
        "Fichier_ERP.xlsx": workbook_bytes(["product_id", "price", "stock_quantity"], [[lot * 1000 + i, 1.5, 2] for i in range(n)]),
        "Export/Fichier_Liaison.XLSX": workbook_bytes(["product_id", "id_web"], [[lot * 1000 + i, f"w{i}"] for i in range(n)]),
        "Fichier_Web.xlsm": workbook_bytes(["sku", "post_type", "post_title", "total_sales"], [[f"w{i}", "product", "t", 1.0] for i in range(n)]),
    }


def watched(log: str):
    """An opener that notes every range read."""

    def open_file(path: str):
        import io

        class Noted(io.FileIO):
            def _note(self, at: int, n: int) -> None:
                with open(log, "a") as out:
                    out.write(f"{path.rsplit('/', 1)[1]} {at} {at + n}\n")

            def read(self, n=-1):
                at = self.tell()
                found = super().read(n)
                self._note(at, len(found))
                return found

        return Noted(path.removeprefix("file:"), "rb")

    return open_file


def test_entries_are_read_once_and_other_entries_never(spark, tmp_path):
    sizes = {}
    for lot in range(3):
        data = zip_bytes({**books(lot, 200), "big/movie.bin": bytes(range(256)) * 4000, "notes.txt": "x"})
        (tmp_path / f"lot{lot}.zip").write_bytes(data)
        sizes[f"lot{lot}.zip"] = len(data)
    log = tmp_path / "log"
    raw = read_catalog(spark, str(tmp_path), rest=None, work=f"{tmp_path}/work", open_file=watched(str(log)))
    planned = [line.split() for line in log.read_text().splitlines()]
    assert all(int(b) - int(a) < 1000 for _, a, b in planned)  # directories alone
    assert [df.count() for _, df in raw.named()] == [600, 600, 600]
    touched = {}
    for name, a, b in (line.split() for line in log.read_text().splitlines()[len(planned) :]):
        touched.setdefault(name, []).append((int(a), int(b)))
    for lot in range(3):
        path = tmp_path / f"lot{lot}.zip"
        ranges = sorted(touched[path.name])
        assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))  # no byte twice
        with zipfile.ZipFile(path) as archive:
            wanted = sum(i.compress_size for i in archive.infolist() if "ichier" in i.filename)
            assert sum(b - a for a, b in ranges) == wanted + 3 * 30


def test_plan_reads_no_content_and_moves_no_content(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(zip_bytes(books()))
    plan = final_plan(read_catalog(spark, str(tmp_path), rest=None).link)
    assert re.search(r"BinaryFile|binaryFile", plan) and "ReadSchema: struct<path:string>" in plan
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2 and "content" not in "".join(re.findall(r"Exchange.*", plan))


def test_both_ways_read_alike(spark, tmp_path):
    for lot in range(2):
        (tmp_path / f"lot #{lot} é%20?.zip").write_bytes(zip_bytes({**books(lot, 5), "x/": "", "é.txt": "ü", "__MACOSX/é.txt": "fork"}))
    ranged = read_entries(archive_index(listed_files(spark, str(tmp_path), "*.zip")))
    whole = archive_entries(read_archives(spark, str(tmp_path)))
    assert rows(ranged) == rows(whole) and ranged.count() == 8
    by_range, by_spark = (read_catalog(spark, str(tmp_path), keep_position=True, open_file=o) for o in (watched(str(tmp_path / "log")), None))
    for (_, a), (_, b) in zip(by_range.named(), by_spark.named()):
        assert a.dtypes == b.dtypes and rows(a) == rows(b)


def test_each_archive_must_be_complete(spark, tmp_path):
    (tmp_path / "good.zip").write_bytes(zip_bytes(books(0)))
    old = books(1)
    old["Fichier_ERP.XLS"] = old.pop("Fichier_ERP.xlsx")
    (tmp_path / "old.zip").write_bytes(zip_bytes(old))
    less = books(2)
    del less["Export/Fichier_Liaison.XLSX"]
    (tmp_path / "less.zip").write_bytes(zip_bytes(less))
    (tmp_path / "none.zip").write_bytes(zip_bytes({"x/": ""}))
    twice = books(3) | {"again/fichier_web.xlsx": workbook_bytes(["sku"], [["w"]])}
    (tmp_path / "twice.zip").write_bytes(zip_bytes(twice))
    for open_file in ({}, {"open_file": None}):
        with pytest.raises(IncompleteArchives) as error:
            read_catalog(spark, str(tmp_path), **open_file)
        text = str(error.value)
        assert "no workbook for fichier_liaison in" in text and "less.zip" in text
        assert re.search(r"no workbook for fichier_erp in \S*old.zip \(only Fichier_ERP.XLS, not .xlsx or .xlsm\)", text)
        assert text.count("none.zip") == 3 and "good.zip" not in text and "twice.zip" not in text
        raw = read_catalog(spark, str(tmp_path), complete=False, rest=None, **open_file)
        assert [r[0] for r in rows(raw.master)] == [0, 2000, 3000]
    gaps = archive_gaps(archive_index(listed_files(spark, str(tmp_path), "*.zip")), list(TABLES), SUFFIXES)
    found = {(r.archive.rsplit("/", 1)[1], r.table_name): (r.problem, r.entries, r.other) for r in gaps.collect()}
    assert found == {
        ("old.zip", "fichier_erp"): ("format", 0, "Fichier_ERP.XLS"),
        ("less.zip", "fichier_liaison"): ("missing", 0, None),
        ("twice.zip", "fichier_web"): ("several", 2, None),
        **{("none.zip", t): ("missing", 0, None) for t in TABLES},
    }


def test_many_gaps_are_summed_up(spark, tmp_path):
    for k in range(6):
        (tmp_path / f"{k}.zip").write_bytes(zip_bytes({"x.txt": "x"}))
    with pytest.raises(IncompleteArchives, match="; and more$"):
        read_catalog(spark, str(tmp_path))


def test_a_folder_without_archives_is_an_error(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.txt").write_text("x")
    for open_file in ({}, {"open_file": None}):
        with pytest.raises(IncompleteArchives, match="no workbook for fichier_erp, fichier_liaison, fichier_web below"):
            read_catalog(spark, str(tmp_path), **open_file)


def entries_of(spark, tmp_path, data: bytes):
    (tmp_path / "a.zip").write_bytes(data)
    return read_entries(archive_index(listed_files(spark, str(tmp_path), "*.zip")), most_bytes=1000)


def test_stored_entries_comments_and_leading_bytes(spark, tmp_path):
    buffer = io.BytesIO(b"#!/bin/sh\n")
    buffer.seek(0, 2)
    with zipfile.ZipFile(buffer, "a") as archive:
        archive.comment = b"a comment"
        archive.writestr("one.txt", "plain", zipfile.ZIP_STORED)
        archive.writestr("two.txt", "packed " * 50, zipfile.ZIP_DEFLATED)
        archive.writestr("empty.txt", "")
    found = {r.entry: bytes(r.content) for r in entries_of(spark, tmp_path, buffer.getvalue()).collect()}
    assert found == {"one.txt": b"plain", "two.txt": b"packed " * 50, "empty.txt": b""}


@pytest.mark.parametrize("case", ["large", "liar", "broken", "method", "no zip"])
def test_refused(spark, tmp_path, case):
    data = zip_bytes({"big.txt": "x" * (1001 if case == "large" else 900)})
    if case == "liar":  # the directory promises fewer bytes than there are
        at = data.rindex(b"PK\x01\x02") + 24
        data = data[:at] + (10).to_bytes(4, "little") + data[at + 4 :]
    elif case == "broken":
        data = data.replace(b"big.txt", b"big.txt", 1)
        at = data.index(b"big.txt") + 8
        data = data[:at] + bytes([data[at] ^ 255]) + data[at + 1 :]
    elif case == "method":
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_BZIP2) as archive:
            archive.writestr("big.txt", "x")
        data = buffer.getvalue()
    elif case == "no zip":
        data = b"nothing"
    expected = {
        "large": "a.zip: big.txt has 1001 bytes, more than 1000",
        "liar": "a.zip: big.txt: its content is not",
        "broken": "a.zip: big.txt: ",
        "method": "a.zip: big.txt: packed by method 12",
        "no zip": "a.zip: no zip archive",
    }
    with pytest.raises(Exception, match=expected[case]):
        entries_of(spark, tmp_path, data).collect()


def test_small_archives_share_tasks_and_batches(spark, tmp_path):
    for k in range(300):
        (tmp_path / f"{k}.zip").write_bytes(zip_bytes({"x.txt": "x"} if k else {}))
    found = listed_files(spark, str(tmp_path), "*.zip")
    assert found.rdd.getNumPartitions() <= 4 and found.count() == 300
    index = archive_index(found)
    plan = final_plan(index)
    assert "Coalesce 4" in plan and plan.count("Exchange") == 1
    paths = pa.RecordBatch.from_pydict({"path": [r.path for r in found.collect()]})
    read = list(_directories(open_anywhere)(iter([paths])))
    assert [b.num_rows for b in read] == [300] and rows(index.select("archive", "entry")) == rows(spark.createDataFrame(
        [(f"file:{tmp_path}/{k}.zip", "x.txt" if k else None) for k in range(300)], "archive string, entry string"))
    one = zip_bytes({f"{k}.txt": "" for k in range(5000)})
    for k in range(3):
        (tmp_path / f"{k}.zip").write_bytes(one)
    first = pa.RecordBatch.from_pydict({"path": [f"{tmp_path}/{k}.zip" for k in range(4)]})
    assert [b.num_rows for b in _directories(open_anywhere)(iter([first]))] == [10000, 5001]


def test_tasks_list_what_spark_lists(spark, tmp_path):
    names = ["a.zip", "b #é%20?.zip", "sub/c.zip", "sub/deep/d=1/e.zip", "_hidden/f.zip", "_x=1/g.zip", ".h.zip", "_i.zip", "sub/j.txt", "k.zip._COPYING_", "L.ZIP"]
    for k, name in enumerate(names):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(b"x" * k)
    (tmp_path / "none").mkdir()
    for start in ("", "file:", "file://"):
        folders = [f"{start}{tmp_path}/{f}" for f in ("in", "none")]
        assert rows(listed_files(spark, folders, "*.zip", list_anywhere)) == rows(listed_files(spark, folders, "*.zip"))
    assert listed_files(spark, folders, "*.zip", list_anywhere).count() == 4  # not the one without a byte


def test_archives_go_to_folders_by_name(spark, tmp_path):
    made = [(f"{k % 40}.zip", zip_bytes({"x.txt": str(k % 40)})) for k in range(80)]
    folder = archive_files(spark.createDataFrame(made, "path string, content binary").repartition(4), f"file://{tmp_path}/lots", 8)
    found = listed_files(spark, archive_folders(folder, 8), "*.zip", list_anywhere)
    assert sorted(r.path.rsplit("/", 1)[1] for r in found.collect()) == sorted({name for name, _ in made})
    assert len({r.path.rsplit("/", 2)[1] for r in found.collect()}) > 4
    assert not [f for f in (tmp_path / "lots").rglob(".*") if f.is_file() and not f.name.endswith(".crc")]
    texts = {r.archive.rsplit("/", 1)[1]: bytes(r.content).decode() for r in read_entries(archive_index(found)).collect()}
    assert texts == {f"{k}.zip": str(k) for k in range(40)}


def test_the_gaps_of_documents_are_found_without_listing_on_the_driver(spark, tmp_path):
    docs = [(k, None if k == 5 else "text é") for k in range(300)] + [(4, "text é")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    gaps = QUERIES["archive_gaps"](spark, str(tmp_path))
    expected = []
    for k in range(300):
        none = k % 13 == 4
        if none or k % 7 == 2:
            expected.append((f"lot-{k}.zip", "fichier_erp", "missing" if none else "format", 0, None if none else "Export/Fichier_ERP.XLS"))
        if none or k % 5 == 1:
            expected.append((f"lot-{k}.zip", "fichier_web", "missing", 0, None))
        if none or k % 11 == 3:
            expected.append((f"lot-{k}.zip", "fichier_liaison", "missing" if none else "several", 0 if none else 2, None))
    plan = final_plan(gaps)
    assert rows(gaps) == sorted(expected, key=repr) and "inaryFile" not in plan
