"""The whole run, from archives on disk to reports, checks and log."""

from __future__ import annotations

import pandas as pd
import pytest
from conftest import rows

from catalograph.operators.joins import FanOut
from catalograph.plans import Catalog, Expectations, read_catalog, run_month
from catalograph.plans.monthly import stage_metrics
from catalograph.schema import TABLES
from catalograph.sources import load_table
from queries.packing import workbook_bytes, zip_bytes

N = 60
DEAR = 57, 58, 59


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("month")
    price = {i: 500.0 + i if i in DEAR else 10.0 + i % 3 for i in range(N)}
    master = [[i, price[i], i % 4] for i in range(N)] + [[5, price[5], 1], [None, 1.0, 1]]
    link = [[i, f"w{i}"] for i in range(N)] + [[7, "w7"], [8, None]]
    web = [[f"w{i}", "product", f"Wine & {i}", float(i % 5) or None] for i in range(N)]
    web += [[f"w{i}", "attachment", "image", None] for i in range(N)] + [["", "product", "x", 1.0], [None] * 4]
    web.append(["w0", "page", "p", 1.0])
    files = {
        "Fichier_ERP.xlsx": workbook_bytes(["product_id", "price", "stock_quantity"], master),
        "Fichier_Liaison.xlsx": workbook_bytes(["product_id", "id_web"], link),
        "Fichier_Web.xlsx": workbook_bytes(["sku", "post_type", "post_title", "total_sales"], web),
    }
    (folder / "in.zip").write_bytes(zip_bytes(files))
    revenue = round(sum(price[i] * (i % 5) for i in range(N)), 2)
    expected = Expectations(N, N, 2 * N + 1, N, N, revenue, len(DEAR) + 1)
    tables = run_month(read_catalog(spark, str(folder / "in.zip")), str(folder / "out"), expected)
    return folder / "out", tables, revenue


def read_parts(folder):
    return pd.concat([pd.read_csv(p) for p in sorted(folder.glob("*.csv"))], ignore_index=True)


def test_tables(run):
    _, tables, revenue = run
    assert {k: tables[k].count() for k in ("fichier_erp", "fichier_liaison", "fichier_web", "report")} == {
        "fichier_erp": N,
        "fichier_liaison": N,
        "fichier_web": N,
        "report": N,
    }
    assert rows(tables["total"]) == [(revenue,)]


def test_checks_report_the_wrong_expectation(run):
    _, tables, _ = run
    passed = {r.check_name: r.passed for r in tables["checks"].collect()}
    assert len(passed) == 7
    assert [name for name, ok in passed.items() if not ok] == ["premium_rows"]


def test_csv_reports_are_ordered(run):
    out, _, _ = run
    report = read_parts(out / "csv" / "report")
    assert len(report) == N and report.chiffre_affaires.is_monotonic_decreasing
    dear = read_parts(out / "csv" / "premium")
    assert sorted(dear.product_id) == list(DEAR) and dear.z_score.is_monotonic_decreasing
    rest = read_parts(out / "csv" / "ordinary")
    assert len(rest) == N - len(DEAR) and rest.z_score.is_monotonic_decreasing
    assert list(rest.columns) == [
        "product_id",
        "id_web",
        "nom_produit",
        "prix_unitaire",
        "z_score",
        "ventes_totales",
        "chiffre_affaires",
        "stock",
    ]


def test_segments_metrics_and_log(run):
    out, tables, _ = run
    assert sorted(p.name for p in (out / "segments").glob("segment=*")) == ["segment=ordinary", "segment=premium"]
    metrics = {(r.step, r.metric): r.value for r in tables["metrics"].collect()}
    assert metrics["read fichier_erp", "rows"] == N + 2
    assert metrics["profile fichier_erp", "duplicates"] == 1
    assert metrics["profile fichier_liaison", "duplicates"] == 1
    assert metrics["clean fichier_web", "rows"] == N
    lines = tables["log"].first().pipeline_log.split("\n")
    assert lines[:3] == [f"fichier_erp: {N + 2}", f"fichier_liaison: {N + 2}", f"fichier_web: {2 * N + 3}"]
    assert lines[3] == "erp_rows: expected 60.00, found 60.00, ok"
    assert lines[9] == "premium_rows: expected 4.00, found 3.00, FAILED"
    assert len(lines) == 10


def test_stored_raw_tables_need_no_copy(spark, run, tmp_path):
    out, tables, revenue = run
    raw = Catalog(*(load_table(spark, f"{out}/raw", name) for name in TABLES))
    again = run_month(raw, str(tmp_path), copy_raw=False)
    assert not (tmp_path / "raw").exists()
    assert rows(again["total"]) == [(revenue,)]
    assert rows(again["report"]) == rows(tables["report"])


def test_metrics_need_no_pass_of_their_own(spark, run, tmp_path):
    """The same figures as a pass over every stored table gives."""
    out, tables, _ = run
    raw = Catalog(*(load_table(spark, f"{out}/raw", name) for name in TABLES))
    cleaned = Catalog(*(tables[name] for name in TABLES))
    assert rows(tables["metrics"]) == rows(stage_metrics(raw, cleaned, tables["report"]))
    again = run_month(raw, str(tmp_path), copy_raw=False)
    assert rows(again["metrics"]) == rows(tables["metrics"])


def test_one_file_per_report(spark, run, tmp_path):
    out, tables, _ = run
    raw = Catalog(*(load_table(spark, f"{out}/raw", name) for name in TABLES))
    again = run_month(raw, str(tmp_path), copy_raw=False, one_file=True, keep_rejected=True, most_fan_out=1)
    assert sorted(p.name for p in (tmp_path / "csv").iterdir() if p.suffix != ".crc") == ["ordinary.csv", "premium.csv", "report.csv", "total.csv"]
    pd.testing.assert_frame_equal(pd.read_csv(tmp_path / "csv" / "report.csv"), read_parts(out / "csv" / "report"))
    assert rows(again["report"]) == rows(tables["report"])
    reasons = sorted(tuple(r._reasons) for r in again["rejected"].collect())
    assert reasons == [("blank_key",)] * 2 + [("other_type",)] * (N + 1)
    assert again["rejected"].count() + again["fichier_web"].count() == raw.listing.count()


def test_a_run_stops_before_joins_that_fan_out(spark, run, tmp_path):
    out, _, _ = run
    raw = Catalog(*(load_table(spark, f"{out}/raw", name) for name in TABLES))
    double = Catalog(raw.master, raw.link, raw.listing.unionByName(raw.listing.where("id_web = 'w3'")))
    with pytest.raises(FanOut, match=r"60 links give 61 rows, more than 1 each; \(3, w3\): 2 rows"):
        run_month(double, str(tmp_path), copy_raw=False, most_fan_out=1)
    assert not (tmp_path / "report").exists()
