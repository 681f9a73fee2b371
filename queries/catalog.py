"""The registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalograph.functions import MISSING_TOKENS, finite, has_all_keys, is_blank, revenue, round_to
from catalograph.functions.exact import exact_sums
from catalograph.operators.checks import Check, Watch, check_lines, count_lines, joined_log, run_checks
from catalograph.operators.clean import (
    REASONS,
    drop_blank_keys,
    drop_null_keys,
    keep_type,
    key_rules,
    listing_rules,
    reason_counts,
    with_reasons,
    write_routed,
)
from catalograph.operators.dedupe import dedupe, dedupe_if_duplicated, dedupe_keep_first
from catalograph.operators.inference import inferred_types
from catalograph.operators.joins import fan_out_keys, heavy_keys, join_sizes, predicted_rows
from catalograph.operators.profile import dup_count, dup_profile, table_counts, type_filter_counts
from catalograph.operators.report import ranked, revenue_report, revenue_total, revenue_total_text
from catalograph.operators.segment import (
    THRESHOLD,
    displayed,
    ordinary,
    premium,
    price_scores,
    with_raw_score,
    with_segment,
)
from catalograph.plans.cleaning import LINK_KEYS, POSITION, Catalog, clean, clean_by_first, profile, read_catalog
from catalograph.plans.monthly import Expectations, catalog_checks, watched_metrics
from catalograph.schema import LINK, LINK_TABLE, LISTING, LISTING_TABLE, MASTER, MASTER_TABLE, TABLES, rename_if_present
from catalograph.sinks import PART, drop_table, save_bucketed, save_table, write_csv, write_one_csv, write_parquet
from catalograph.sources import (
    SUFFIXES,
    archive_entries,
    archive_gaps,
    archive_index,
    list_anywhere,
    listed_files,
    load_table,
    read_csv,
    read_large_csv,
    register,
    workbook_rows,
    workbook_table,
)
from catalograph.storage import numbered, row_position
from catalograph.versions import load_version, replace_table
from queries import views
from queries.landing import document_lots
from queries.packing import archive_files, archive_folders, document_archives, table_archives
from queries.views import table, with_views
from queries.work import new_path, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str, *needs: str) -> Callable[[Query], Query]:
    """Register a query with its SQL, which may use the named views."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        ORACLES[name] = with_views(sql, *needs)
        return fn

    return add


# Counts and profiles


@query(
    "table_counts",
    """
    SELECT 'erp' AS table_name, COUNT(*) AS n FROM erp
    UNION ALL SELECT 'liaison', COUNT(*) FROM liaison
    UNION ALL SELECT 'web', COUNT(*) FROM web""",
    "erp", "liaison", "web",
)
def q_table_counts(spark, sf_dir):
    raw = views.raw_catalog(spark, sf_dir)
    for name, df in (("erp", raw.master), ("liaison", raw.link), ("web", raw.listing)):
        register(df, name)
    return table_counts({name: spark.table(name) for name in ("erp", "liaison", "web")})


@query(
    "dup_profile_key",
    """
    SELECT COUNT(*) AS lignes_totales, COUNT(DISTINCT product_id) AS prod_uniques,
           COUNT(*) - COUNT(DISTINCT product_id) AS nb_doublons
    FROM erp WHERE product_id IS NOT NULL""",
    "erp",
)
def q_dup_profile_key(spark, sf_dir):
    names = ("lignes_totales", "prod_uniques", "nb_doublons")
    return dup_profile(views.erp(spark, sf_dir), ["product_id"], ignore_null_keys=True, names=names)


@query(
    "dup_profile_pair",
    """
    SELECT COUNT(*) AS total_lignes, COUNT(DISTINCT (id_web, product_id)) AS couples_uniques,
           COUNT(*) - COUNT(DISTINCT (id_web, product_id)) AS nb_doublons
    FROM liaison""",
    "liaison",
)
def q_dup_profile_pair(spark, sf_dir):
    return dup_profile(views.liaison(spark, sf_dir), LINK_KEYS, ignore_null_keys=False)


@query(
    "dup_count_first",
    "SELECT COUNT(*) - COUNT(DISTINCT (user_id, event_type)) AS nb_doublons FROM events",
)
def q_dup_count_first(spark, sf_dir):
    return dup_count(table(spark, sf_dir, "events"), ["user_id", "event_type"])


@query(
    "type_filter_counts",
    """
    SELECT COUNT(*) AS n_in, COUNT(*) FILTER (WHERE post_type = 'product') AS n_kept,
           COUNT(*) FILTER (WHERE post_type IS DISTINCT FROM 'product') AS n_rejected
    FROM web""",
    "web",
)
def q_type_filter_counts(spark, sf_dir):
    return type_filter_counts(views.web(spark, sf_dir))


@query(
    "star_pair_profile",
    """
    SELECT COUNT(*) AS total_lignes, COUNT(DISTINCT (l_orderkey, l_partkey)) AS couples_uniques,
           COUNT(*) - COUNT(DISTINCT (l_orderkey, l_partkey)) AS nb_doublons
    FROM lineitem""",
)
def q_star_pair_profile(spark, sf_dir):
    return dup_profile(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"], ignore_null_keys=False)


# De-duplication


@query("dedupe_product", "SELECT * FROM erp_d", "erp_d")
def q_dedupe_product(spark, sf_dir):
    return views.erp_d(spark, sf_dir)


@query("dedupe_pair", "SELECT * FROM liaison_d", "liaison_d")
def q_dedupe_pair(spark, sf_dir):
    return views.liaison_d(spark, sf_dir)


GATED_PAIR = """
    SELECT r.product_id, r.id_web
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id_web, product_id ORDER BY id_web) AS rn FROM {t}) r
    CROSS JOIN (SELECT COUNT(*) - COUNT(DISTINCT (id_web, product_id)) AS nb FROM {t}) d
    WHERE d.nb = 0 OR (r.id_web IS NOT NULL AND r.product_id IS NOT NULL AND r.rn = 1)"""

GATED_KEY = """
    SELECT r.product_id, r.price, r.stock_quantity
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY price, stock_quantity) AS rn FROM {t}) r
    CROSS JOIN (SELECT COUNT(*) - COUNT(DISTINCT product_id) AS nb FROM {t} WHERE product_id IS NOT NULL) d
    WHERE d.nb = 0 OR (r.product_id IS NOT NULL AND r.rn = 1)"""


@query("dedupe_gated_dups", GATED_PAIR.format(t="liaison"), "liaison")
def q_dedupe_gated_dups(spark, sf_dir):
    return dedupe_if_duplicated(views.liaison(spark, sf_dir), LINK_KEYS, count_null_keys=True)


@query("dedupe_gated_clean", GATED_PAIR.format(t="liaison_u"), "liaison_u")
def q_dedupe_gated_clean(spark, sf_dir):
    return dedupe_if_duplicated(views.liaison_u(spark, sf_dir), LINK_KEYS, count_null_keys=True)


@query("dedupe_gated_key_dups", GATED_KEY.format(t="erp"), "erp")
def q_dedupe_gated_key_dups(spark, sf_dir):
    return dedupe_if_duplicated(views.erp(spark, sf_dir), ["product_id"])


@query("dedupe_gated_key_clean", GATED_KEY.format(t="erp_u"), "erp_u")
def q_dedupe_gated_key_clean(spark, sf_dir):
    return dedupe_if_duplicated(views.erp_u(spark, sf_dir), ["product_id"])


@query(
    "dedupe_keep_first",
    """
    SELECT event_id, user_id, event_type, value
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) x
    WHERE rn = 1""",
)
def q_dedupe_keep_first(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return dedupe_keep_first(events, ["user_id", "event_type"], "event_id")


@query(
    "star_dedupe",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_partkey
                                       ORDER BY l_linenumber, l_quantity, l_extendedprice) AS rn
          FROM lineitem) x
    WHERE rn = 1""",
)
def q_star_dedupe(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    return dedupe(lines, ["l_orderkey", "l_partkey"], order_by=[F.col("l_linenumber").asc()])


# Filters and names


@query("drop_blank_keys", "SELECT * FROM web_nb", "web_nb")
def q_drop_blank_keys(spark, sf_dir):
    return views.web_nb(spark, sf_dir)


@query("keep_type_or_null", "SELECT * FROM web_c", "web_c")
def q_keep_type_or_null(spark, sf_dir):
    return views.web_c(spark, sf_dir)


@query("keep_type_strict", "SELECT * FROM web WHERE post_type = 'product'", "web")
def q_keep_type_strict(spark, sf_dir):
    return keep_type(views.web(spark, sf_dir), keep_null=False)


@query("drop_null_keys", "SELECT * FROM liaison WHERE product_id IS NOT NULL AND id_web IS NOT NULL", "liaison")
def q_drop_null_keys(spark, sf_dir):
    return drop_null_keys(views.liaison(spark, sf_dir))


@query("rename_if_present", "SELECT id_web, post_type, post_title, total_sales FROM web", "web")
def q_rename_if_present(spark, sf_dir):
    return rename_if_present(views.web(spark, sf_dir).withColumnRenamed("id_web", "sku"))


# Former cleaning rules


@query("legacy_link", "SELECT * FROM legacy_link", "legacy_link")
def q_legacy_link(spark, sf_dir):
    return clean_by_first(views.liaison(spark, sf_dir), sequence="id_web")


@query("legacy_listing", "SELECT * FROM legacy_web", "legacy_web")
def q_legacy_listing(spark, sf_dir):
    return clean_by_first(views.web(spark, sf_dir), sequence=["post_title", "total_sales"])


@query(
    "legacy_report",
    """
    SELECT e.product_id, l.id_web, w.post_title AS nom_produit, e.price AS prix_unitaire,
           COALESCE(w.total_sales, 0) AS ventes_totales,
           ROUND(e.price * COALESCE(w.total_sales, 0), 2) AS chiffre_affaires, e.stock_quantity AS stock
    FROM erp_d e JOIN legacy_link l ON e.product_id = l.product_id JOIN legacy_web w ON l.id_web = w.id_web""",
    "erp_d", "legacy_link", "legacy_web",
)
def q_legacy_report(spark, sf_dir):
    raw = views.raw_catalog(spark, sf_dir)
    master = clean_by_first(raw.master, sequence=["price", "stock_quantity"])
    link = clean_by_first(raw.link, sequence="id_web")
    listing = clean_by_first(raw.listing, sequence=["post_title", "total_sales"])
    return revenue_report(master, link, listing, heavy_keys(raw.link, "product_id"))


# Report, total, score


@query("revenue_report", "SELECT * FROM report", "report")
def q_revenue_report(spark, sf_dir):
    report = views.stored_report(spark, sf_dir)
    return ranked(report, "chiffre_affaires", row_position(report))


@query(
    "ordered_report_file",
    """
    SELECT ROW_NUMBER() OVER (ORDER BY chiffre_affaires DESC NULLS LAST, product_id, id_web, nom_produit, prix_unitaire,
                              ventes_totales, stock) AS row_number,
           product_id, id_web, chiffre_affaires
    FROM report""",
    "report",
)
def q_ordered_report_file(spark, sf_dir):
    """The ordered report as one CSV file, read back by many tasks with the numbers of its rows."""
    report = views.stored_report(spark, sf_dir)
    path = write_one_csv(ranked(report, "chiffre_affaires", row_position(report)), new_path(spark, "report") + ".csv")
    rows = read_large_csv(spark, path, report.schema, position=True, split_bytes=1 << 16, work=new_path(spark, "ranges"))
    rows = stored(rows.select("_file", "_position", "product_id", "id_web", "chiffre_affaires"), "report-rows")
    return numbered(rows, "_file", "_position", width=1 << 14).select("row_number", "product_id", "id_web", "chiffre_affaires")


@query(
    "exact_totals",
    """
    SELECT event_type, ROUND(fsum(value), 2) AS total, COUNT(value) AS total_n FROM events GROUP BY event_type
    UNION ALL
    SELECT 'revenue', ROUND(fsum(chiffre_affaires), 2), COUNT(chiffre_affaires) FROM report""",
    "report",
)
def q_exact_totals(spark, sf_dir):
    """Sums that are the same bits whatever the partitioning."""
    events = exact_sums(table(spark, sf_dir, "events"), "value", ["event_type"])
    revenue = exact_sums(views.report(spark, sf_dir), "chiffre_affaires").withColumn("event_type", F.lit("revenue"))
    return events.unionByName(revenue).withColumn("total", round_to(F.col("total"), 2))


@query(
    "exact_zscore",
    """
    SELECT product_id, id_web, ROUND((prix_unitaire - a) / NULLIF(sd, 0), 4) AS z_score
    FROM report CROSS JOIN (SELECT fsum(prix_unitaire) / COUNT(prix_unitaire) AS a, STDDEV(prix_unitaire) AS sd FROM report) s""",
    "report",
)
def q_exact_zscore(spark, sf_dir):
    scored = with_raw_score(views.stored_report(spark, sf_dir), "prix_unitaire", exact=True)
    return displayed(scored).select("product_id", "id_web", "z_score")


@query(
    "predicted_report_rows",
    """
    SELECT name, CAST(rows AS DOUBLE) AS rows FROM (
      SELECT 'raw' AS name, COUNT(*) AS rows
      FROM erp e JOIN liaison l ON e.product_id = l.product_id JOIN web w ON l.id_web = w.id_web
      UNION ALL
      SELECT 'clean', COUNT(*) FROM report
      UNION ALL
      SELECT 'hot', COUNT(*) FROM hot_report) x""",
    "report", "hot_report",
)
def q_predicted_report_rows(spark, sf_dir):
    """How many rows the joins will give, from counts per key alone."""
    raw, kept = views.raw_catalog(spark, sf_dir), clean(views.raw_catalog(spark, sf_dir), keep_undoubled_nulls=False)
    hot = join_sizes(views.hot_link(spark, sf_dir), kept.master, views.hot_listing(spark, sf_dir))
    sizes = {"raw": join_sizes(raw.link, raw.master, raw.listing), "clean": join_sizes(kept.link, kept.master, kept.listing), "hot": hot}
    parts = [predicted_rows(s).select(F.lit(name).alias("name"), F.col("rows").cast("double").alias("rows")) for name, s in sizes.items()]
    return reduce(DataFrame.unionByName, parts)


@query(
    "fan_out_keys",
    """
    SELECT product_id, id_web, links, rows FROM (
      SELECT l.product_id, l.id_web, COUNT(*) AS rows FROM erp e JOIN liaison l ON e.product_id = l.product_id
      JOIN web w ON l.id_web = w.id_web GROUP BY 1, 2) j
    JOIN (SELECT product_id, id_web, COUNT(*) AS links FROM liaison GROUP BY 1, 2) k USING (product_id, id_web)
    WHERE rows > links""",
    "erp", "liaison", "web",
)
def q_fan_out_keys(spark, sf_dir):
    raw = views.raw_catalog(spark, sf_dir)
    found = fan_out_keys(join_sizes(raw.link, raw.master, raw.listing))
    return found.select("product_id", "id_web", "links", F.col("rows").cast("long").alias("rows"))


@query(
    "rejected_rows",
    """
    SELECT 'fichier_web' AS table_name, reason, COUNT(*) AS n FROM (
      SELECT CASE WHEN COALESCE(id_web, '') = '' THEN 'blank_key' END AS reason FROM web
      UNION ALL SELECT CASE WHEN post_type <> 'product' THEN 'other_type' END FROM web
      UNION ALL SELECT CASE WHEN COALESCE(id_web, '') = '' OR post_type <> 'product' THEN 'rejected' ELSE 'accepted' END FROM web) x
    WHERE reason IS NOT NULL GROUP BY reason
    UNION ALL
    SELECT 'fichier_erp', reason, COUNT(*) FROM (
      SELECT CASE WHEN product_id IS NULL THEN 'null_key' WHEN rn > 1 THEN 'duplicate' END AS reason FROM ranked
      UNION ALL SELECT CASE WHEN product_id IS NULL OR rn > 1 THEN 'rejected' ELSE 'accepted' END FROM ranked) x
    WHERE reason IS NOT NULL GROUP BY reason
    UNION ALL SELECT 'both parts', 'rows', COUNT(*) FROM web""",
    "web", "ranked",
)
def q_rejected_rows(spark, sf_dir):
    """Listing rows routed in one pass, accepted and rejected ones apart; master rows told why they go."""
    tagged = with_reasons(views.web(spark, sf_dir), listing_rules())
    kept, gone = write_routed(tagged, new_path(spark, "routed"))
    listing = reason_counts(kept.withColumn(REASONS, F.array().cast("array<string>")).unionByName(gone))
    ranked_rows, rules = key_rules(views.erp(spark, sf_dir), ["product_id"])
    master = reason_counts(with_reasons(ranked_rows, rules))
    both = kept.unionByName(gone.drop(REASONS)).agg(F.lit("rows").alias("reason"), F.count("*").alias("n"))
    parts = {"fichier_web": listing, "fichier_erp": master, "both parts": both}
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("table_name"), "reason", "n") for name, df in parts.items()])


@query(
    "bucketed_join",
    """
    SELECT product_id, id_web, price, stock_quantity FROM erp_d
    JOIN (SELECT CASE WHEN n % 3 = 0 THEN 7 ELSE l_partkey END AS product_id, CAST(n AS VARCHAR(20)) AS id_web
          FROM (SELECT l_partkey, l_orderkey * 8 + l_linenumber AS n FROM lineitem) x) l USING (product_id)""",
    "erp_d",
)
def q_bucketed_join(spark, sf_dir):
    """Master and links stored in buckets by product, the hot product in parts: the join moves no row."""
    link = views.hot_link(spark, sf_dir)
    heavy = stored(heavy_keys(link, "product_id"), "heavy")
    names = [f"catalograph_{new_path(spark, 'bucketed').rsplit('-', 1)[1]}" for _ in range(2)]
    links = save_bucketed(link, names[0], new_path(spark, "links"), "product_id", 16, heavy, F.col("id_web"))
    masters = save_bucketed(views.erp_d(spark, sf_dir), names[1], new_path(spark, "masters"), "product_id", 16, heavy)
    joined = links.join(masters, ["product_id", PART]).select("product_id", "id_web", "price", "stock_quantity")
    for name in names:  # the plan has what it needs, and the files stay
        spark.sql(f"DROP TABLE {name}")
    return joined


@query(
    "revenue_total",
    "SELECT COALESCE(ROUND(SUM(chiffre_affaires), 2), 0) AS chiffre_affaires_total FROM report",
    "report",
)
def q_revenue_total(spark, sf_dir):
    return revenue_total(views.report(spark, sf_dir))


@query(
    "revenue_total_formatted",
    "SELECT format('{:,.2f}', ROUND(SUM(chiffre_affaires), 2)) AS chiffre_affaires_total FROM report",
    "report",
)
def q_revenue_total_formatted(spark, sf_dir):
    return revenue_total_text(views.report(spark, sf_dir))


SCORED_COLUMNS = """
    product_id, id_web, nom_produit, prix_unitaire, ROUND(z, 4) AS z_score,
    ventes_totales, chiffre_affaires, stock"""


@query("price_zscore", f"SELECT {SCORED_COLUMNS} FROM scored", "scored")
def q_price_zscore(spark, sf_dir):
    return price_scores(views.stored_report(spark, sf_dir))


def _by_score(spark, sf_dir, part):
    """One part of the scored report in the order of its scores; only the report is written."""
    report = views.stored_report(spark, sf_dir)
    placed = report.withColumn("_place", row_position(report)[0])
    return ranked(displayed(part(with_raw_score(placed, "prix_unitaire"))), "z_score").drop("_place")


@query("premium", f"SELECT {SCORED_COLUMNS} FROM scored WHERE z > 2", "scored")
def q_premium(spark, sf_dir):
    return _by_score(spark, sf_dir, premium)


@query("ordinary", f"SELECT {SCORED_COLUMNS} FROM scored WHERE z <= 2", "scored")
def q_ordinary(spark, sf_dir):
    return _by_score(spark, sf_dir, ordinary)


@query(
    "price_segments",
    f"""
    SELECT {SCORED_COLUMNS}, CASE WHEN z > 2 THEN 'premium' WHEN z <= 2 THEN 'ordinary' END AS segment
    FROM scored""",
    "scored",
)
def q_price_segments(spark, sf_dir):
    return displayed(with_segment(views.scored(spark, sf_dir)))


@query(
    "star_revenue",
    """
    SELECT l_partkey, l_orderkey, ROUND(p_retailprice * l_quantity, 2) AS chiffre_affaires
    FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey""",
)
def q_star_revenue(spark, sf_dir):
    part, lines, orders = (table(spark, sf_dir, t) for t in ("part", "lineitem", "orders"))
    return (
        lines.join(part, lines.l_partkey == part.p_partkey)
        .join(orders, lines.l_orderkey == orders.o_orderkey)
        .select(
            "l_partkey", "l_orderkey", revenue(F.col("p_retailprice"), F.col("l_quantity")).alias("chiffre_affaires")
        )
    )


@query(
    "star_revenue_total",
    """
    SELECT ROUND(SUM(ROUND(p_retailprice * l_quantity, 2)), 2) AS chiffre_affaires_total
    FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey""",
)
def q_star_revenue_total(spark, sf_dir):
    return revenue_total(q_star_revenue(spark, sf_dir))


@query(
    "events_zscore",
    """
    SELECT event_id, value, ROUND((value - a) / NULLIF(sd, 0), 4) AS z_score
    FROM events CROSS JOIN (SELECT AVG(value) AS a, STDDEV(value) AS sd FROM events) s
    WHERE (value - a) / NULLIF(sd, 0) > 2""",
)
def q_events_zscore(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return displayed(premium(with_raw_score(events, "value")), after="value")


@query(
    "price_zscore_gaps",
    """
    SELECT product_id, id_web, ROUND((price - a) / NULLIF(sd, 0), 4) AS z_score,
           CASE WHEN (price - a) / NULLIF(sd, 0) > 2 THEN 'premium'
                WHEN (price - a) / NULLIF(sd, 0) <= 2 THEN 'ordinary' END AS segment
    FROM gapped CROSS JOIN (SELECT AVG(price) AS a, STDDEV(price) AS sd FROM gapped) s""",
    "gapped",
)
def q_price_zscore_gaps(spark, sf_dir):
    rows = with_raw_score(stored(views.gapped_report(spark, sf_dir), "gapped"), "prix_unitaire")
    return displayed(with_segment(rows)).select("product_id", "id_web", "z_score", "segment")


@query("skewed_report", "SELECT * FROM hot_report", "hot_report")
def q_skewed_report(spark, sf_dir):
    """A third of the links belong to one product, which is spread over tasks."""
    link = views.hot_link(spark, sf_dir)
    return revenue_report(views.erp_d(spark, sf_dir), link, views.hot_listing(spark, sf_dir), heavy_keys(link, "product_id"))


# Checks and log


@query(
    "checks",
    """
    SELECT check_name, expected, actual, ABS(expected - actual) < 0.005 AS passed FROM (
      SELECT 'erp_rows' AS check_name,
             CAST((SELECT COUNT(DISTINCT product_id) FROM erp) AS DOUBLE) AS expected,
             CAST((SELECT COUNT(*) FROM erp_d) AS DOUBLE) AS actual
      UNION ALL SELECT 'link_rows',
             CAST((SELECT COUNT(DISTINCT (id_web, product_id)) FROM liaison
                   WHERE id_web IS NOT NULL AND product_id IS NOT NULL) AS DOUBLE),
             CAST((SELECT COUNT(*) FROM liaison_d) AS DOUBLE)
      UNION ALL SELECT 'web_nonblank_rows',
             CAST((SELECT COUNT(*) - COUNT(*) FILTER (WHERE COALESCE(id_web, '') = '') FROM web) AS DOUBLE),
             CAST((SELECT COUNT(*) FROM web_nb) AS DOUBLE)
      UNION ALL SELECT 'web_type_rows',
             CAST((SELECT COUNT(*) - COUNT(*) FILTER (WHERE post_type <> 'product') FROM web_nb) AS DOUBLE),
             CAST((SELECT COUNT(*) FROM web_c) AS DOUBLE)
      UNION ALL SELECT 'report_rows',
             CAST((SELECT COUNT(DISTINCT (product_id, id_web)) FROM report) AS DOUBLE),
             CAST((SELECT COUNT(*) FROM report) AS DOUBLE)
      UNION ALL SELECT 'revenue_total',
             (SELECT ROUND(SUM(prix_unitaire * ventes_totales), 2) FROM report),
             (SELECT ROUND(SUM(chiffre_affaires), 2) FROM report)
      UNION ALL SELECT 'premium_rows',
             CAST((SELECT COUNT(*) - COUNT(*) FILTER (WHERE z <= 2) FROM scored) AS DOUBLE),
             CAST((SELECT COUNT(*) FROM scored WHERE z > 2) AS DOUBLE)
    ) c""",
    "scored",
)
def q_checks(spark, sf_dir):
    """The shipped checks on cleaned, stored tables. Expected figures are aggregates that go
    another way; ``report_rows`` fails, as listings without a type fan out."""
    raw = views.stored_catalog(spark, sf_dir)
    kept = clean(raw)
    cleaned = Catalog(stored(kept.master, "erp"), stored(kept.link, "liaison"), stored(kept.listing, "web"))
    report = stored(revenue_report(cleaned.master, cleaned.link, cleaned.listing, heavy_keys(cleaned.link, "product_id")), "report")
    keyed = drop_blank_keys(raw.listing)
    segments = with_segment(with_raw_score(report, "prix_unitaire"))
    rows, price = F.count("*"), F.col("prix_unitaire")
    other = F.count_if(F.coalesce(F.col("post_type") != "product", F.lit(False)) & ~is_blank(F.col("id_web")))
    blank = F.count_if(is_blank(F.col("id_web")))
    limit = report.agg((F.avg(price) + THRESHOLD * F.stddev_samp(price)).alias("limit")).scalar()
    expected = Expectations(
        master_rows=raw.master.agg(F.count_distinct("product_id")).scalar(),
        link_rows=raw.link.where(has_all_keys(LINK_KEYS)).agg(F.count_distinct(F.struct(*LINK_KEYS))).scalar(),
        listing_keyed_rows=raw.listing.agg(rows - blank).scalar(),
        listing_rows=raw.listing.agg(rows - blank - other).scalar(),
        report_rows=report.agg(F.count_distinct(F.struct("product_id", "id_web"))).scalar(),
        revenue=report.agg(round_to(F.sum(price * F.col("ventes_totales")), 2)).scalar(),
        premium_rows=report.agg(rows - F.count_if(price <= limit)).scalar(),
    )
    return catalog_checks(cleaned, keyed, report, segments, expected)


@query(
    "run_report",
    """
    SELECT STRING_AGG(msg, chr(10) ORDER BY step) AS pipeline_log FROM (
      SELECT 1 AS step, 'erp: ' || CAST(COUNT(*) AS VARCHAR) AS msg FROM erp
      UNION ALL SELECT 2, 'liaison: ' || CAST(COUNT(*) AS VARCHAR) FROM liaison
      UNION ALL SELECT 3, 'web: ' || CAST(COUNT(*) AS VARCHAR) FROM web) m""",
    "erp", "liaison", "web",
)
def q_run_report(spark, sf_dir):
    raw = views.raw_catalog(spark, sf_dir)
    return joined_log(count_lines([("erp", raw.master), ("liaison", raw.link), ("web", raw.listing)]))


@query(
    "check_log",
    """
    SELECT 'rows: expected ' || format('{:,.2f}', CAST(k AS DOUBLE)) || ', found '
           || format('{:,.2f}', CAST(n AS DOUBLE)) || ', FAILED' || chr(10)
           || 'keys: expected ' || format('{:,.2f}', CAST(k AS DOUBLE)) || ', found '
           || format('{:,.2f}', CAST(k AS DOUBLE)) || ', ok' AS pipeline_log
    FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT product_id) AS k FROM erp) c""",
    "erp",
)
def q_check_log(spark, sf_dir):
    master = views.erp(spark, sf_dir)
    keys = F.count_distinct("product_id")
    checks = run_checks([(master, [Check("rows", keys, F.count("*")), Check("keys", keys, keys)])])
    return joined_log(check_lines(checks, ["rows", "keys"]))


@query(
    "stage_metrics",
    """
    SELECT 'read fichier_erp' AS step, 'rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value FROM erp
    UNION ALL SELECT 'read fichier_liaison', 'rows', COUNT(*) FROM liaison
    UNION ALL SELECT 'read fichier_web', 'rows', COUNT(*) FROM web
    UNION ALL SELECT 'profile fichier_erp', 'total', COUNT(product_id) FROM erp
    UNION ALL SELECT 'profile fichier_erp', 'distinct', COUNT(DISTINCT product_id) FROM erp
    UNION ALL SELECT 'profile fichier_erp', 'duplicates', COUNT(product_id) - COUNT(DISTINCT product_id) FROM erp
    UNION ALL SELECT 'profile fichier_liaison', 'total', COUNT(*) FROM liaison
    UNION ALL SELECT 'profile fichier_liaison', 'distinct', COUNT(DISTINCT (id_web, product_id)) FROM liaison
    UNION ALL SELECT 'profile fichier_liaison', 'duplicates',
                     COUNT(*) - COUNT(DISTINCT (id_web, product_id)) FROM liaison
    UNION ALL SELECT 'clean fichier_erp', 'rows', COUNT(*) FROM erp_d
    UNION ALL SELECT 'clean fichier_liaison', 'rows', COUNT(*) FROM liaison_d
    UNION ALL SELECT 'clean fichier_web', 'rows', COUNT(*) FROM web_c
    UNION ALL SELECT 'report', 'rows', COUNT(*) FROM report
    UNION ALL SELECT 'report', 'revenue', ROUND(SUM(chiffre_affaires), 2) FROM report""",
    "report",
)
def q_stage_metrics(spark, sf_dir):
    """Figures gathered while the tables are written; the profiles are those that cleaning needs."""
    watch, rows = Watch(), F.count("*")

    def kept(df, step, label, **figures):
        return stored(watch.on(df, step, rows=rows, **figures), label)

    raw = Catalog(*(kept(df, f"read {name}", "raw") for name, df in views.raw_catalog(spark, sf_dir).named()))
    profiles = profile(raw)
    cleaned = Catalog(*(kept(df, f"clean {name}", "clean") for name, df in clean(raw, profiles=profiles).named()))
    heavy = heavy_keys(cleaned.link, "product_id")
    revenue_sum = round_to(F.sum(finite(F.col("chiffre_affaires"))), 2)
    kept(revenue_report(cleaned.master, cleaned.link, cleaned.listing, heavy), "report", "report", revenue=revenue_sum)
    return watched_metrics(watch, profiles, spark)


# Files in, files out

MISSING_SQL = ", ".join(f"'{token}'" for token in MISSING_TOKENS)


@query(
    "csv_roundtrip",
    "SELECT NULLIF(id_web, '') AS id_web, post_type, post_title, total_sales FROM web",
    "web",
)
def q_csv_roundtrip(spark, sf_dir):
    path = write_csv(views.web(spark, sf_dir), new_path(spark, "web-csv"))
    return read_csv(spark, path, LISTING)


TEXTS_SQL = f"""
    SELECT doc_id, CASE WHEN text NOT IN ({MISSING_SQL}) THEN text END AS text,
           CASE WHEN source NOT IN ({MISSING_SQL}) THEN source END AS source
    FROM documents"""


@query("csv_large_file", TEXTS_SQL)
def q_csv_large_file(spark, sf_dir):
    """All texts, line breaks and quotes included, as one file that many tasks read."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    path = write_one_csv(documents, new_path(spark, "documents") + ".csv")
    return read_large_csv(spark, path, documents.schema, split_bytes=1 << 18, work=new_path(spark, "ranges"))


@query(
    "csv_inferred",
    """
    SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, p_retailprice,
           CASE WHEN p_partkey % 3 > 0 THEN DATE '2024-01-01' + CAST(p_size AS INTEGER) END AS day,
           CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN '2.5' ELSE 'x' || p_size END AS mixed,
           CAST(NULL AS VARCHAR) AS nothing
    FROM part""",
)
def q_csv_inferred(spark, sf_dir):
    """A file read without a schema has the types that all its cells allow."""
    path = write_csv(views.typed_parts(spark, sf_dir), new_path(spark, "parts-csv"))
    return read_csv(spark, path, None)


@query(
    "inferred_types",
    """
    WITH cells AS (
      SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size,
             CAST(p_retailprice AS VARCHAR) AS p_retailprice,
             CASE WHEN p_partkey % 3 > 0 THEN CAST(DATE '2024-01-01' + CAST(p_size AS INTEGER) AS VARCHAR) END AS day,
             CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN '2.5' ELSE 'x' || p_size END AS mixed,
             CAST(NULL AS VARCHAR) AS nothing
      FROM part),
    long AS (
      SELECT 'p_partkey' AS "column", p_partkey AS cell FROM cells UNION ALL SELECT 'p_name', p_name FROM cells
      UNION ALL SELECT 'p_size', p_size FROM cells UNION ALL SELECT 'p_retailprice', p_retailprice FROM cells
      UNION ALL SELECT 'day', day FROM cells UNION ALL SELECT 'mixed', mixed FROM cells
      UNION ALL SELECT 'nothing', nothing FROM cells)
    SELECT "column", CASE WHEN COUNT(cell) = 0 THEN 'missing'
             WHEN COUNT(cell) = COUNT(*) FILTER (WHERE regexp_full_match(cell, '[+-]?[0-9]{1,19}')) THEN 'bigint'
             WHEN COUNT(cell) = COUNT(*) FILTER (WHERE regexp_full_match(cell, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?')) THEN 'double'
             WHEN COUNT(cell) = COUNT(*) FILTER (WHERE TRY_CAST(cell AS DATE) IS NOT NULL) THEN 'date' ELSE 'string' END AS type,
           COUNT(cell) AS n_values, COUNT(*) - COUNT(cell) AS n_missing
    FROM long GROUP BY 1""",
)
def q_inferred_types(spark, sf_dir):
    parts = views.typed_parts(spark, sf_dir)
    return inferred_types(parts.select(*[F.col(c).cast("string").alias(c) for c in parts.columns]))


@query("csv_text_roundtrip", TEXTS_SQL)
def q_csv_text_roundtrip(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    path = write_csv(documents, new_path(spark, "documents-csv"))
    return read_csv(spark, path, documents.schema)


@query(
    "archive_entries",
    """
    SELECT 'doc-' || doc_id || '.zip' AS archive, 'Textes/' || lang || '/Corps.v1.TXT' AS entry,
           'corps.v1' AS table_name, text AS content
    FROM documents
    UNION ALL
    SELECT 'doc-' || doc_id || '.zip', 'Source.CSV', 'source', source FROM documents""",
)
def q_archive_entries(spark, sf_dir):
    entries = archive_entries(document_archives(table(spark, sf_dir, "documents")))
    return entries.withColumn("content", F.decode("content", "UTF-8"))


@query(
    "workbook_rows",
    """
    SELECT 'fichier_erp' AS table_name, product_id, price, stock_quantity, CAST(NULL AS VARCHAR) AS id_web,
           CAST(NULL AS VARCHAR) AS post_type, CAST(NULL AS VARCHAR) AS post_title,
           CAST(NULL AS DOUBLE) AS total_sales
    FROM erp
    UNION ALL SELECT 'fichier_liaison', product_id, NULL, NULL, id_web, NULL, NULL, NULL FROM liaison
    UNION ALL SELECT 'fichier_web', NULL, NULL, NULL, NULLIF(id_web, ''), post_type, post_title, total_sales
    FROM web""",
    "erp", "liaison", "web",
)
def q_workbook_rows(spark, sf_dir):
    raw = views.raw_catalog(spark, sf_dir)
    rows = workbook_rows(archive_entries(table_archives([raw.master, raw.link, raw.listing])))
    # Read three times below, once per table: parse the workbooks once.
    rows = stored(rows, "workbook-rows")
    out = None
    for name, schema in ((MASTER_TABLE, MASTER), (LINK_TABLE, LINK), (LISTING_TABLE, LISTING)):
        typed = workbook_table(rows, name, schema).drop("archive", "entry", "row_idx")
        typed = typed.withColumn("table_name", F.lit(name))
        out = typed if out is None else out.unionByName(typed, allowMissingColumns=True)
    return out.select(
        "table_name",
        "product_id",
        "price",
        "stock_quantity",
        "id_web",
        "post_type",
        "post_title",
        "total_sales",
    )


UNTYPED = ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in (("post_type", "VARCHAR"), ("post_title", "VARCHAR"), ("total_sales", "DOUBLE")))


@query(
    "catalog_from_archives",
    f"""
    SELECT 'fichier_erp' AS table_name, product_id, price, stock_quantity, CAST(NULL AS VARCHAR) AS id_web, {UNTYPED}
    FROM erp
    UNION ALL SELECT 'fichier_liaison', product_id, NULL, NULL, id_web, NULL, NULL, NULL FROM liaison
    UNION ALL SELECT 'fichier_web', NULL, NULL, NULL, NULLIF(id_web, ''), post_type, post_title, total_sales FROM web""",
    "erp", "liaison", "web",
)
def q_catalog_from_archives(spark, sf_dir):
    """Archives written as files, then read from there."""
    raw = views.raw_catalog(spark, sf_dir)
    files = archive_files(table_archives([raw.master, raw.link, raw.listing]), new_path(spark, "archives"))
    out = None
    for name, df in read_catalog(spark, files, rest=None, work=new_path(spark, "work")).named():
        df = df.withColumn("table_name", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.select("table_name", "product_id", "price", "stock_quantity", "id_web", "post_type", "post_title", "total_sales")


LOT_FOLDERS = 1024  # of the archives of documents


@query(
    "archive_gaps",
    """
    WITH expected AS (
      SELECT doc_id, t.table_name FROM documents
      CROSS JOIN (SELECT 'fichier_erp' AS table_name UNION ALL SELECT 'fichier_liaison' UNION ALL SELECT 'fichier_web') t),
    found AS (
      SELECT doc_id, table_name,
             CASE WHEN doc_id % 13 = 4 THEN 0
                  WHEN table_name = 'fichier_erp' AND doc_id % 7 = 2 THEN 0
                  WHEN table_name = 'fichier_web' AND doc_id % 5 = 1 THEN 0
                  WHEN table_name = 'fichier_liaison' AND doc_id % 11 = 3 THEN 2 ELSE 1 END AS entries,
             CASE WHEN doc_id % 13 <> 4 AND table_name = 'fichier_erp' AND doc_id % 7 = 2
                  THEN 'Export/Fichier_ERP.XLS' END AS other
      FROM expected)
    SELECT 'lot-' || doc_id || '.zip' AS archive, table_name,
           CASE WHEN entries > 1 THEN 'several' WHEN other IS NULL THEN 'missing' ELSE 'format' END AS problem,
           CAST(entries AS BIGINT) AS entries, other
    FROM found WHERE entries <> 1""",
)
def q_archive_gaps(spark, sf_dir):
    """Archives written as files, of which some lack a workbook, hold an old one or one too many."""
    folder = archive_files(document_lots(table(spark, sf_dir, "documents")), new_path(spark, "lots"), LOT_FOLDERS)
    index = archive_index(listed_files(spark, archive_folders(folder, LOT_FOLDERS), "*.zip", list_anywhere))
    gaps = archive_gaps(index, list(TABLES), SUFFIXES)
    return gaps.withColumn("archive", F.regexp_replace("archive", "^.*/", ""))


@query(
    "legacy_from_archives",
    """
    SELECT product_id, MAX(price) AS price, MAX(stock_quantity) AS stock_quantity, COUNT(*) AS n
    FROM erp_d GROUP BY product_id""",
    "erp_d",
)
def q_legacy_from_archives(spark, sf_dir):
    """The former rules on archives read from files: the first row of a key by archive, workbook and row."""
    raw = views.raw_catalog(spark, sf_dir)
    files = archive_files(table_archives([raw.master, raw.link, raw.listing]), new_path(spark, "archives"))
    master = read_catalog(spark, files, rest=None, keep_position=True).master
    kept = clean_by_first(master, sequence=list(POSITION))
    return kept.groupBy("product_id").agg(
        F.max("price").alias("price"), F.max("stock_quantity").alias("stock_quantity"), F.count("*").alias("n")
    )


@query(
    "saved_tables",
    """
    SELECT 'erp' AS table_name, product_id, price FROM erp
    UNION ALL SELECT 'again', product_id, price FROM erp WHERE product_id IS NOT NULL""",
    "erp",
)
def q_saved_tables(spark, sf_dir):
    """A catalog table created, then replaced; both states are read back."""
    name = "catalograph_" + new_path(spark, "saved").rsplit("-", 1)[1]
    raw = views.erp(spark, sf_dir).select("product_id", "price")
    first = stored(save_table(raw, name), "saved")
    again = save_table(raw.where("product_id IS NOT NULL"), name)
    out = first.withColumn("table_name", F.lit("erp")).unionByName(again.withColumn("table_name", F.lit("again")))
    out = stored(out.select("table_name", "product_id", "price"), "saved")
    drop_table(spark, name)
    return out


@query("kept_after_failure", "SELECT product_id, price FROM erp", "erp")
def q_kept_after_failure(spark, sf_dir):
    """A table whose replacement fails in the midst of its write: the rows before are still read."""
    place = new_path(spark, "versions")
    raw = views.erp(spark, sf_dir).select("product_id", "price")
    replace_table(raw, place)
    broken = F.when(F.col("product_id").isNull(), F.raise_error(F.lit("planted failure")).cast("double")).otherwise(F.col("price"))
    try:
        replace_table(raw.withColumn("price", broken), place)
    except Exception as error:
        if "planted failure" not in str(error):
            raise
    return load_version(spark, place)


@query(
    "report_sinks",
    """
    SELECT 'csv' AS sink, product_id, id_web, chiffre_affaires, CAST(NULL AS VARCHAR) AS segment FROM report
    UNION ALL
    SELECT 'parquet', product_id, id_web, chiffre_affaires,
           CASE WHEN z > 2 THEN 'premium' WHEN z <= 2 THEN 'ordinary' END
    FROM scored""",
    "scored",
)
def q_report_sinks(spark, sf_dir):
    """The ordered CSV report and the segments by folder, written and read back."""
    report = views.stored_report(spark, sf_dir)
    path = write_csv(ranked(report, "chiffre_affaires", row_position(report)), new_path(spark, "report-csv"))
    read = read_csv(spark, path, report.schema).withColumn("segment", F.lit(None).cast("string"))
    segments = displayed(with_segment(with_raw_score(report, "prix_unitaire")))
    folder = new_path(spark, "segments")
    write_parquet(segments, f"{folder}/segments", "segment")
    parts = load_table(spark, folder, "segments", segments.schema)
    names = ["sink", "product_id", "id_web", "chiffre_affaires", "segment"]
    return read.withColumn("sink", F.lit("csv")).select(*names).unionByName(parts.withColumn("sink", F.lit("parquet")).select(*names))
