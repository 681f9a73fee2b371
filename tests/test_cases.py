"""Small hand-made cases for each operator."""

from __future__ import annotations

import duckdb
import pytest
from conftest import rows
from pyspark.sql import functions as F

from catalograph.functions import round_to, table_name_of, thousands
from catalograph.operators.checks import Check, run_checks
from catalograph.operators.clean import drop_blank_keys, drop_null_keys, keep_type
from catalograph.operators.dedupe import dedupe, dedupe_if_duplicated, dedupe_keep_first
from catalograph.operators.profile import dup_count, dup_profile, type_filter_counts
from catalograph.operators.report import ranked, revenue_report, revenue_total, revenue_total_text
from catalograph.operators.segment import (
    displayed,
    ordinary,
    premium,
    price_scores,
    with_raw_score,
    with_segment,
)
from catalograph.plans import clean_by_first
from catalograph.schema import LINK, LISTING, MASTER, conform, parse_cell, rename_if_present

PAIR = "product_id long, id_web string"
KEYS = ["id_web", "product_id"]
REPORT = (
    "product_id long, id_web string, nom_produit string, prix_unitaire double, "
    "ventes_totales double, chiffre_affaires double, stock int"
)


def prices(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "product_id long, prix_unitaire double")


# Profiles


def test_pair_with_null_counts_once(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (2, "3")], PAIR)
    assert rows(dup_profile(df, KEYS, ignore_null_keys=False)) == [(4, 3, 1)]
    assert rows(dup_profile(df, KEYS, ignore_null_keys=True)) == [(1, 1, 0)]


def test_single_key_profile_skips_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], PAIR)
    assert rows(dup_profile(df, ["product_id"], ignore_null_keys=True)) == [(3, 2, 1)]


def test_dup_count_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (None, None), (None, None), (1, "a")], PAIR)
    assert rows(dup_count(df, KEYS)) == [(2,)]


def test_type_counts_reject_null_types(spark):
    df = spark.createDataFrame([("product",), ("page",), (None,)], "post_type string")
    assert rows(type_filter_counts(df)) == [(3, 1, 2)]


# De-duplication


def test_gate_on_clean_pairs_keeps_all(spark):
    df = spark.createDataFrame([(1, None), (2, "3")], PAIR)
    assert rows(dedupe_if_duplicated(df, KEYS, count_null_keys=True)) == [(1, None), (2, "3")]


def test_gate_on_repeated_pairs_drops_null_keys(spark):
    df = spark.createDataFrame([(1, None), (2, "3"), (2, "3")], PAIR)
    assert rows(dedupe_if_duplicated(df, KEYS, count_null_keys=True)) == [(2, "3")]


def test_gate_when_only_null_pairs_repeat(spark):
    df = spark.createDataFrame([(1, None), (1, None)], PAIR)
    assert rows(dedupe_if_duplicated(df, KEYS, count_null_keys=True)) == []


def test_gate_with_more_columns_than_keys(spark):
    schema = PAIR + ", note string"
    clean = spark.createDataFrame([(1, None, "x"), (2, "3", "y")], schema)
    assert rows(dedupe_if_duplicated(clean, KEYS, count_null_keys=True)) == [(1, None, "x"), (2, "3", "y")]
    nulls_repeat = spark.createDataFrame([(1, None, "x"), (1, None, "y"), (2, "3", "z")], schema)
    assert rows(dedupe_if_duplicated(nulls_repeat, KEYS, count_null_keys=True)) == [(2, "3", "z")]


def test_gate_on_one_key_ignores_repeated_nulls(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (2, "b")], PAIR)
    assert rows(dedupe_if_duplicated(df, ["product_id"])) == [(2, "b"), (None, "a"), (None, "a")]


def test_gate_on_empty_table(spark):
    df = spark.createDataFrame([], PAIR)
    assert rows(dedupe_if_duplicated(df, KEYS, count_null_keys=True)) == []
    assert rows(dedupe_if_duplicated(df, ["product_id"])) == []


def test_survivor_does_not_depend_on_input_order(spark):
    data = [(1, "b", 2.0), (1, "a", 3.0), (1, None, 1.0), (2, None, 5.0), (2, None, 4.0)]
    schema = "k long, s string, x double"
    expected = [(1, "a", 3.0), (2, None, 4.0)]
    for order in (data, data[::-1]):
        assert rows(dedupe(spark.createDataFrame(order, schema).repartition(3), ["k"])) == expected


def test_explicit_order_picks_the_survivor(spark):
    df = spark.createDataFrame([(1, "a", 3.0), (1, "b", 9.0), (1, "c", 9.0)], "k long, s string, x double")
    assert rows(dedupe(df, ["k"], [F.col("x").desc()])) == [(1, "b", 9.0)]
    assert rows(dedupe(df, ["k"], ["x"])) == [(1, "a", 3.0)]


def test_dedupe_keeps_a_column_called_row_num(spark):
    df = spark.createDataFrame([(1, 7), (1, 5)], "k long, row_num int")
    assert rows(dedupe(df, ["k"])) == [(1, 5)]


def test_dedupe_with_a_map_column(spark):
    data = [(1, {"a": "2"}), (1, {"a": "1", "b": None}), (1, None)]
    df = spark.createDataFrame(data, "k long, extra map<string,string>")
    assert [r.extra for r in dedupe(df, ["k"]).collect()] == [{"a": "1", "b": None}]
    assert [r.extra for r in dedupe(df, ["k"], [F.col("k").desc()]).collect()] == [{"a": "1", "b": None}]


def test_keep_first_follows_the_sequence_and_groups_nulls(spark):
    df = spark.createDataFrame([(3, 1, "x"), (1, 1, "y"), (2, None, "z"), (5, None, "w")], "seq long, k long, v string")
    assert rows(dedupe_keep_first(df, ["k"], "seq")) == [(1, 1, "y"), (2, None, "z")]


# Filters and names


def test_space_is_not_blank(spark):
    df = spark.createDataFrame([("",), (" ",), (None,), ("a",)], "id_web string")
    assert rows(drop_blank_keys(df)) == [(" ",), ("a",)]


def test_type_filter_with_and_without_nulls(spark):
    df = spark.createDataFrame([("product",), ("page",), (None,)], "post_type string")
    assert rows(keep_type(df)) == [("product",), (None,)]
    assert rows(keep_type(df, keep_null=False)) == [("product",)]


def test_drop_null_keys_uses_the_columns_there_are(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y")], "product_id long, note string")
    assert rows(drop_null_keys(df)) == [(1, "x")]
    assert rows(drop_null_keys(df.select("note"))) == [("x",), ("y",)]


def test_rename(spark):
    assert rename_if_present(spark.createDataFrame([("a", 1)], "sku string, n int")).columns == ["id_web", "n"]
    assert rename_if_present(spark.createDataFrame([("a",)], "SKU string")).columns == ["SKU"]
    assert rename_if_present(spark.createDataFrame([("a",)], "id_web string")).columns == ["id_web"]
    with pytest.raises(ValueError):
        rename_if_present(spark.createDataFrame([("a", "b")], "sku string, id_web string"))


def test_former_rules_on_a_listing(spark):
    df = spark.createDataFrame(
        [(2, "a", "product"), (1, "a", "product"), (3, None, "product"), (4, "b", None), (5, "c", "page")],
        "row_idx long, sku string, post_type string",
    )
    assert rows(clean_by_first(df, "row_idx")) == [(1, "a", "product")]


def test_former_rules_without_known_columns(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x")], "row_idx long, note string")
    assert rows(clean_by_first(df, "row_idx")) == [(1, "x"), (1, "x")]


# Cells


@pytest.mark.parametrize(
    ("text", "field", "value"),
    [
        ("5", "long", 5),
        ("5.0", "long", 5),
        ("9007199254740993", "long", 9007199254740993),
        (None, "long", None),
        ("5.0", "int", 5),
        ("5", "double", 5.0),
        ("05", "string", "05"),
    ],
)
def test_parse_cell(spark, text, field, value):
    dtype = {"long": MASTER["product_id"], "int": MASTER["stock_quantity"], "double": MASTER["price"]}.get(
        field, LINK["id_web"]
    ).dataType
    df = spark.createDataFrame([(text,)], "t string")
    assert rows(df.select(parse_cell(F.col("t"), dtype, "t"))) == [(value,)]


@pytest.mark.parametrize("text", ["abc", "5.7", "99999999999999999999"])
def test_bad_whole_number(spark, text):
    df = spark.createDataFrame([(text, "1")], "product_id string, id_web string")
    with pytest.raises(Exception, match="column product_id"):
        conform(df, LINK).collect()
    assert rows(conform(df, LINK, strict=False)) == [(None, "1")]


@pytest.mark.parametrize(
    ("path", "name"),
    [
        ("Fichier_ERP.xlsx", "fichier_erp"),
        ("a.b/C/Fichier.Web.XLSX", "fichier.web"),
        ("plain", "plain"),
        ("d/.hidden", ".hidden"),
    ],
)
def test_table_name(spark, path, name):
    df = spark.createDataFrame([(path,)], "p string")
    assert rows(df.select(table_name_of(F.col("p")))) == [(name,)]


# Report


def catalog(spark, master, link, listing):
    return (spark.createDataFrame(m, s) for m, s in ((master, MASTER), (link, LINK), (listing, LISTING)))


def test_report_joins_and_fans_out(spark):
    master, link, listing = catalog(
        spark,
        [(1, 10.0, 3), (2, 5.5, None), (3, None, 1), (None, 9.0, 9)],
        [(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "a"), (9, "a"), (2, None)],
        [("a", "product", "A", None), ("b", "product", "B", 2.0), ("c", None, "C", 3.0)]
        + [("c", "product", "C2", 1.0), ("d", "product", "D", 4.0), (None, "product", "N", 1.0)],
    )
    assert rows(revenue_report(master, link, listing)) == [
        (1, "a", "A", 10.0, 0.0, 0.0, 3),
        (1, "b", "B", 10.0, 2.0, 20.0, 3),
        (2, "c", "C", 5.5, 3.0, 16.5, None),
        (2, "c", "C2", 5.5, 1.0, 5.5, None),
        (3, "d", "D", None, 4.0, None, 1),
    ]


def test_total(spark):
    df = spark.createDataFrame([(1.25,), (None,), (float("nan"),), (1234567.0,)], "chiffre_affaires double")
    assert rows(revenue_total(df)) == [(1234568.25,)]
    assert rows(revenue_total_text(df)) == [("1,234,568.25",)]
    assert rows(revenue_total(df.limit(0))) == [(0.0,)]


def test_ranked_puts_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame([(2, 1.0), (1, 1.0), (3, None), (4, 9.0)], "product_id long, chiffre_affaires double")
    assert [r.product_id for r in ranked(df, "chiffre_affaires").collect()] == [4, 1, 2, 3]


def test_rounding_is_that_of_sql_on_doubles(spark):
    found = spark.range(200_000).select(
        ((F.rand(7) - 0.5) * 1000).alias("x"), (F.floor(F.rand(8) * 10**7) / 1000).alias("near_half")
    )
    values = [v for r in found.collect() for v in r] + [1.005, 2.675, -1.005, 0.125, -0.125, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    ours = df.select("x", round_to(F.col("x"), 2).alias("r2"), round_to(F.col("x"), 4).alias("r4")).toPandas()
    theirs = duckdb.sql("SELECT x, round(x, 2) AS r2, round(x, 4) AS r4 FROM ours").df()
    assert (ours == theirs).all().all()


def test_thousands(spark):
    df = spark.createDataFrame([(1234567.891,), (0.0,), (-1000.0,)], "x double")
    assert rows(df.select(thousands(F.col("x")))) == [("-1,000.00",), ("0.00",), ("1,234,567.89",)]


# Scores


def test_zero_deviation_is_in_neither_part(spark):
    scored = with_raw_score(prices(spark, 5.0, 5.0, 5.0), "prix_unitaire")
    assert [r.z_score for r in displayed(scored).collect()] == [None] * 3
    assert premium(scored).count() == ordinary(scored).count() == 0


def test_one_row_is_in_neither_part(spark):
    scored = with_raw_score(prices(spark, 5.0), "prix_unitaire")
    assert premium(scored).count() == ordinary(scored).count() == 0


def test_null_price_is_in_neither_part(spark):
    scored = with_raw_score(prices(spark, None, 1.0, 9.0), "prix_unitaire")
    assert premium(scored).count() + ordinary(scored).count() == 2


def test_no_rows_to_score(spark):
    scored = with_raw_score(spark.createDataFrame([], REPORT), "prix_unitaire")
    assert premium(scored).count() == ordinary(scored).count() == 0


def test_threshold_uses_the_unrounded_score(spark):
    # 2.00004 rounds to 2.0 but is above 2.
    data = [(1, 1.0, 2.00004), (2, 1.0, 2.0)]
    scored = spark.createDataFrame(data, "product_id long, prix_unitaire double, _z double")
    assert rows(displayed(premium(scored))) == [(1, 1.0, 2.0)]
    assert rows(displayed(ordinary(scored))) == [(2, 1.0, 2.0)]
    assert rows(with_segment(scored).select("segment")) == [("ordinary",), ("premium",)]


# The 30 premium rows the original data set gives, as
# (price, z-score, units sold, revenue).
GOLDEN = [
    (225.0, 6.9221, 5.0, 1125.0),
    (217.5, 6.6524, 0.0, 0.0),
    (191.3, 5.7103, 3.0, 573.9),
    (176.0, 5.1602, 13.0, 2288.0),
    (175.0, 5.1242, 0.0, 0.0),
    (157.0, 4.477, 0.0, 0.0),
    (137.0, 3.7578, 5.0, 685.0),
    (135.0, 3.6859, 2.0, 270.0),
    (126.5, 3.3803, 11.0, 1391.5),
    (124.8, 3.3191, 0.0, 0.0),
    (122.0, 3.2185, 0.0, 0.0),
    (121.0, 3.1825, 0.0, 0.0),
    (121.0, 3.1825, 0.0, 0.0),
    (116.4, 3.0171, 0.0, 0.0),
    (115.0, 2.9667, 2.0, 230.0),
    (115.0, 2.9667, 0.0, 0.0),
    (114.0, 2.9308, 0.0, 0.0),
    (112.0, 2.8589, 0.0, 0.0),
    (109.6, 2.7726, 0.0, 0.0),
    (108.5, 2.733, 2.0, 217.0),
    (105.6, 2.6287, 0.0, 0.0),
    (105.0, 2.6072, 0.0, 0.0),
    (105.0, 2.6072, 0.0, 0.0),
    (104.0, 2.5712, 1.0, 104.0),
    (102.3, 2.5101, 0.0, 0.0),
    (100.0, 2.4274, 0.0, 0.0),
    (99.0, 2.3914, 0.0, 0.0),
    (93.0, 2.1757, 0.0, 0.0),
    (92.0, 2.1397, 0.0, 0.0),
    (88.4, 2.0103, 0.0, 0.0),
]
MEAN, DEVIATION, JOINED_ROWS = 32.493264, 27.810477, 714


def test_golden_rows(spark):
    """The golden prices among 684 others that give the known mean and deviation."""
    prices_ = [p for p, *_ in GOLDEN]
    n = JOINED_ROWS - len(GOLDEN)
    centre = (JOINED_ROWS * MEAN - sum(prices_)) / n
    squares = (JOINED_ROWS - 1) * DEVIATION**2 - sum((p - MEAN) ** 2 for p in prices_) - n * (centre - MEAN) ** 2
    spread = (squares / n) ** 0.5
    filler = [centre - spread, centre + spread] * (n // 2)
    listed = [(i, p, s) for i, (p, _, s, _) in enumerate(GOLDEN)]
    listed += [(1000 + i, p, 0.0) for i, p in enumerate(filler)]
    master = spark.createDataFrame([(i, p, 1) for i, p, _ in listed], MASTER)
    link = spark.createDataFrame([(i, f"w{i}") for i, *_ in listed], LINK)
    listing = spark.createDataFrame([(f"w{i}", "product", "x", s) for i, _, s in listed], LISTING)
    report = revenue_report(master, link, listing)
    kept = {r.product_id: r for r in price_scores(report).where("z_score > 2").collect()}
    assert sorted(kept) == list(range(30))
    for i, (price, z, sales, amount) in enumerate(GOLDEN):
        assert (kept[i].prix_unitaire, kept[i].ventes_totales, kept[i].chiffre_affaires) == (price, sales, amount)
        assert abs(kept[i].z_score - z) < 1.5e-4


# Checks


def test_checks_pass_fail_and_never_raise(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    found = run_checks(
        [
            (df, [Check("rows", 2, F.count("*")), Check("sum", 3.004, F.sum("x")), Check("bad", 9, F.count("*"))]),
            (df.limit(0), [Check("missing", 1, F.sum("x"))]),
        ]
    )
    assert {r.check_name: r.passed for r in found.collect()} == {
        "rows": True,
        "sum": True,
        "bad": False,
        "missing": False,
    }


def test_prices_that_are_not_finite_have_no_score(spark):
    prices = [1.0, 2.0, 3.0, float("nan"), float("inf"), float("-inf"), None]
    scored = with_segment(with_raw_score(spark.createDataFrame([(p,) for p in prices], "price double"), "price"))
    assert [r.segment for r in scored.orderBy("price").where("_z IS NOT NULL").collect()] == ["ordinary"] * 3
    assert scored.where("_z IS NULL AND segment IS NULL").count() == 4


def test_total_skips_revenues_that_are_not_finite(spark):
    report = spark.createDataFrame([(1.25,), (float("nan"),), (float("inf"),), (None,)], "chiffre_affaires double")
    assert revenue_total(report).first()[0] == 1.25
