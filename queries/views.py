"""Catalog tables made from the test tables, with edge cases planted.

The test tables hold no NULL, blank or repeated key, so these views add some to
the whole tables, in one scan each. ``ORACLE_VIEWS`` says the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.operators.clean import drop_blank_keys, keep_type
from catalograph.operators.dedupe import dedupe
from catalograph.operators.joins import heavy_keys
from catalograph.operators.report import revenue_report
from catalograph.operators.segment import displayed, with_raw_score, with_segment
from catalograph.plans.cleaning import LINK_KEYS, Catalog
from catalograph.sources import load_table
from queries.work import stored

# The columns read, declared: no job to infer a schema.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_size int, p_retailprice double",
    "events": "event_id bigint, user_id bigint, event_type string, value double",
    "orders": "o_orderkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double",
    "documents": "doc_id bigint, text string, lang string, source string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, sf_dir, f"{name}.parquet", SCHEMAS[name])


def _web_id() -> Column:
    return (F.lit(10000) + F.col("p_partkey")).cast("string")


def _planted(usual: list[Column], condition: Column, extra: Column) -> Column:
    """One row per usual value, and one more for ``extra`` where the condition holds."""
    return F.explode(F.when(condition, F.array(*usual, extra)).otherwise(F.array(*usual)))


def _priced_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event prices one part; a part costs its highest."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("stock_quantity"))
    n_parts = parts.agg(F.count("*")).scalar()
    events = table(spark, sf_dir, "events").groupBy((F.col("event_id") % n_parts).alias("p_partkey"))
    return parts.join(events.agg(F.max("value").alias("price")), "p_partkey")


def erp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master: some exact copies, some NULL keys."""
    key, no_key = F.col("p_partkey"), F.lit(None).cast("bigint")
    copied, unkeyed = key % 50 == 0, key % 97 == 0
    ids = (
        F.when(copied & unkeyed, F.array(key, key, no_key))
        .when(copied, F.array(key, key))
        .when(unkeyed, F.array(key, no_key))
        .otherwise(F.array(key))
    )
    return _priced_parts(spark, sf_dir).select(F.explode(ids).alias("product_id"), "price", "stock_quantity")


def erp_u(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master without a repeated key, but with NULL ones."""
    key = F.col("p_partkey")
    ids = _planted([key], key % 97 == 0, F.lit(None).cast("bigint"))
    return _priced_parts(spark, sf_dir).select(ids.alias("product_id"), "price", "stock_quantity")


def liaison_u(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link without a repeated pair; some web ids are NULL."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("product_id"), F.when(key % 9 != 0, _web_id()).alias("id_web")
    )


def liaison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link with repeated pairs and NULL web ids."""
    key = F.col("p_partkey")
    ids = _planted([F.when(key % 9 != 0, _web_id())], key % 20 == 1, _web_id())
    return table(spark, sf_dir, "part").select(key.alias("product_id"), ids.alias("id_web"))


def web(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing: products and attachments, some rows without a type, blank keys, NULL sales."""
    key = F.col("p_partkey")
    post_type = _planted([F.lit("product"), F.lit("attachment")], key % 41 == 0, F.lit(None).cast("string"))
    return table(spark, sf_dir, "part").select(
        F.when(key % 31 == 0, None).when(key % 37 == 0, "").otherwise(_web_id()).alias("id_web"),
        post_type.alias("post_type"),
        F.col("p_name").alias("post_title"),
        F.nullif(F.col("p_size") % 5, F.lit(0)).cast("double").alias("total_sales"),
    )


def raw_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog(erp(spark, sf_dir), liaison(spark, sf_dir), web(spark, sf_dir))


def stored_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The raw tables written once, for queries that read them several times."""
    raw = raw_catalog(spark, sf_dir)
    return Catalog(stored(raw.master, "erp"), stored(raw.link, "liaison"), stored(raw.listing, "web"))


def erp_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(erp(spark, sf_dir), ["product_id"])


def liaison_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(liaison(spark, sf_dir), LINK_KEYS)


def web_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_blank_keys(web(spark, sf_dir))


def web_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_type(web_nb(spark, sf_dir))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = liaison(spark, sf_dir)
    heavy = heavy_keys(link, "product_id")
    return revenue_report(erp_d(spark, sf_dir), dedupe(link, LINK_KEYS), web_c(spark, sf_dir), heavy)


def stored_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report written once: sorted or scored, it is read more than once."""
    return stored(report(spark, sf_dir), "report")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_raw_score(stored_report(spark, sf_dir), "prix_unitaire")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored report written once, a folder per segment: each part reads its own."""
    return stored(displayed(with_segment(scored(spark, sf_dir))), "segments", "segment")


def gapped_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report with prices that are NaN, infinite or missing."""
    key, price = F.col("product_id"), F.col("prix_unitaire")
    gaps = (
        F.when(key % 13 == 0, F.lit(float("nan")))
        .when(key % 17 == 0, F.lit(float("inf")))
        .when(key % 19 == 0, F.lit(float("-inf")))
        .when(key % 23 == 0, F.lit(None).cast("double"))
        .otherwise(price)
    )
    return report(spark, sf_dir).withColumn("prix_unitaire", gaps)


def hot_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of which a third belong to one product."""
    line = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    product = F.when(line % 3 == 0, F.lit(7).cast("bigint")).otherwise(F.col("l_partkey"))
    return table(spark, sf_dir, "lineitem").select(product.alias("product_id"), line.cast("string").alias("id_web"))


def hot_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        line.cast("string").alias("id_web"),
        F.concat(F.lit("line "), line).alias("post_title"),
        F.col("l_quantity").alias("total_sales"),
    )


def typed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with a column of each type a file may show: days with gaps, mixed values, nothing."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        "p_size",
        "p_retailprice",
        F.when(key % 3 > 0, F.date_add(F.to_date(F.lit("2024-01-01")), size)).alias("day"),
        F.when(key % 3 == 0, size.cast("string")).when(key % 3 == 1, "2.5").otherwise(F.concat(F.lit("x"), size)).alias("mixed"),
        F.lit(None).cast("string").alias("nothing"),
    )


# The SQL says what the views above say.
ORACLE_VIEWS = {
    "priced": """
        SELECT p_partkey, price, p_size
        FROM part JOIN (SELECT event_id % (SELECT COUNT(*) FROM part) AS k, MAX(value) AS price FROM events GROUP BY 1) e
             ON k = p_partkey""",
    "erp": """
        SELECT p_partkey AS product_id, price, p_size AS stock_quantity FROM priced
        UNION ALL
        SELECT p_partkey, price, p_size FROM priced WHERE p_partkey % 50 = 0
        UNION ALL
        SELECT CAST(NULL AS BIGINT), price, p_size FROM priced WHERE p_partkey % 97 = 0""",
    "erp_u": """
        SELECT p_partkey AS product_id, price, p_size AS stock_quantity FROM priced
        UNION ALL
        SELECT CAST(NULL AS BIGINT), price, p_size FROM priced WHERE p_partkey % 97 = 0""",
    "liaison_u": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 9 = 0 THEN NULL
                    ELSE CAST(10000 + p_partkey AS VARCHAR(20)) END AS id_web
        FROM part""",
    "liaison": """
        SELECT product_id, id_web FROM liaison_u
        UNION ALL
        SELECT p_partkey, CAST(10000 + p_partkey AS VARCHAR(20)) FROM part WHERE p_partkey % 20 = 1""",
    "web": """
        SELECT CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 37 = 0 THEN ''
                    ELSE CAST(10000 + p_partkey AS VARCHAR(20)) END AS id_web,
               t.post_type, p_name AS post_title,
               CAST(NULLIF(p_size % 5, 0) AS DOUBLE) AS total_sales
        FROM part CROSS JOIN (SELECT 'product' AS post_type UNION ALL SELECT 'attachment'
                              UNION ALL SELECT CAST(NULL AS VARCHAR(20))) t
        WHERE t.post_type IS NOT NULL OR p_partkey % 41 = 0""",
    "erp_d": """
        SELECT product_id, price, stock_quantity
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY price, stock_quantity) AS rn
              FROM erp WHERE product_id IS NOT NULL) x
        WHERE rn = 1""",
    "liaison_d": """
        SELECT product_id, id_web
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_web, product_id ORDER BY id_web) AS rn
              FROM liaison WHERE id_web IS NOT NULL AND product_id IS NOT NULL) x
        WHERE rn = 1""",
    "web_nb": """
        SELECT * FROM web WHERE id_web IS NOT NULL AND id_web <> ''""",
    "web_c": """
        SELECT * FROM web_nb WHERE post_type = 'product' OR post_type IS NULL""",
    "report": """
        SELECT e.product_id, l.id_web, w.post_title AS nom_produit, e.price AS prix_unitaire,
               COALESCE(w.total_sales, 0) AS ventes_totales,
               ROUND(e.price * COALESCE(w.total_sales, 0), 2) AS chiffre_affaires,
               e.stock_quantity AS stock
        FROM erp_d e JOIN liaison_d l ON e.product_id = l.product_id
                     JOIN web_c w ON l.id_web = w.id_web""",
    "scored": """
        SELECT *, (prix_unitaire - a) / NULLIF(sd, 0) AS z
        FROM report CROSS JOIN (SELECT AVG(prix_unitaire) AS a, STDDEV(prix_unitaire) AS sd FROM report) s""",
    "hot_report": """
        SELECT e.product_id, l.id_web, w.post_title AS nom_produit, e.price AS prix_unitaire,
               COALESCE(w.total_sales, 0) AS ventes_totales,
               ROUND(e.price * COALESCE(w.total_sales, 0), 2) AS chiffre_affaires, e.stock_quantity AS stock
        FROM erp_d e
        JOIN (SELECT CASE WHEN n % 3 = 0 THEN 7 ELSE l_partkey END AS product_id, CAST(n AS VARCHAR(20)) AS id_web
              FROM (SELECT l_partkey, l_orderkey * 8 + l_linenumber AS n FROM lineitem) x) l ON e.product_id = l.product_id
        JOIN (SELECT CAST(n AS VARCHAR(20)) AS id_web, 'line ' || n AS post_title, l_quantity AS total_sales
              FROM (SELECT l_quantity, l_orderkey * 8 + l_linenumber AS n FROM lineitem) x) w ON l.id_web = w.id_web""",
    "gapped": """
        SELECT product_id, id_web, CASE WHEN product_id % 13 = 0 OR product_id % 17 = 0 OR product_id % 19 = 0
               OR product_id % 23 = 0 THEN NULL ELSE prix_unitaire END AS price
        FROM report""",
    "ranked": """
        SELECT product_id, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY price, stock_quantity) AS rn FROM erp""",
    "legacy_link": """
        SELECT DISTINCT product_id, id_web FROM liaison WHERE product_id IS NOT NULL AND id_web IS NOT NULL""",
    "legacy_web": """
        SELECT id_web, post_type, post_title, total_sales
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_web ORDER BY post_title, total_sales NULLS LAST) AS rn
              FROM web WHERE id_web IS NOT NULL AND post_type = 'product') x
        WHERE rn = 1""",
}

# Which views each view is built from.
NEEDS = {
    "erp": ["priced"],
    "erp_u": ["priced"],
    "hot_report": ["erp_d"],
    "gapped": ["report"],
    "liaison": ["liaison_u"],
    "erp_d": ["erp"],
    "liaison_d": ["liaison"],
    "web_nb": ["web"],
    "web_c": ["web_nb"],
    "report": ["erp_d", "liaison_d", "web_c"],
    "scored": ["report"],
    "legacy_link": ["liaison"],
    "ranked": ["erp"],
    "legacy_web": ["web"],
}


def with_views(sql: str, *names: str) -> str:
    """``sql`` preceded by the named views and all they need, as CTEs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    ctes = ",\n".join(f"{name} AS ({ORACLE_VIEWS[name]})" for name in ordered)
    return f"WITH {ctes}\n{sql}" if ctes else sql
