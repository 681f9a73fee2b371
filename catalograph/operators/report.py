"""Product revenue: master joined to its web listing through the link table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.functions import finite, revenue, round_to, thousands
from catalograph.functions.exact import exact_sums
from catalograph.operators.joins import spread_join


def revenue_report(
    master: DataFrame, link: DataFrame, listing: DataFrame, heavy: DataFrame | None = None
) -> DataFrame:
    """One row per (master, link, listing) match with price, units sold and revenue.

    ``heavy`` names the products to spread over several tasks
    (``joins.heavy_keys`` of the link table). A master that comes straight from its
    de-duplication needs it: the plain join reuses that partitioning, which adaptive
    execution cannot split. The second join is left to adaptive execution, which splits
    heavy ``id_web`` partitions itself: both its inputs are shuffled for that join alone.
    """
    linked = spread_join(
        link.select("product_id", F.col("id_web").cast("string").alias("id_web")),
        master.select("product_id", "price", "stock_quantity"),
        "product_id",
        spread_by=F.col("id_web"),
        heavy=heavy,
    )
    listed = listing.select(F.col("id_web").cast("string").alias("id_web"), "post_title", "total_sales")
    return linked.join(listed, "id_web", "inner").select(
        "product_id",
        "id_web",
        F.col("post_title").alias("nom_produit"),
        F.col("price").alias("prix_unitaire"),
        F.coalesce("total_sales", F.lit(0.0)).alias("ventes_totales"),
        revenue(F.col("price"), F.col("total_sales")).alias("chiffre_affaires"),
        F.col("stock_quantity").alias("stock"),
    )


def revenue_total(report: DataFrame, name: str = "chiffre_affaires_total", exact: bool = False) -> DataFrame:
    """One row: total revenue to the cent; NULL, NaN and infinite revenues are skipped, no row gives 0.

    With ``exact`` the cents do not depend on the order in which tasks add up (:mod:`catalograph.functions.exact`).
    """
    if exact:
        sums = exact_sums(report, "chiffre_affaires", name="_sum")
        return sums.select(F.coalesce(round_to(F.col("_sum"), 2), F.lit(0.0)).cast("double").alias(name))
    amounts = finite(F.col("chiffre_affaires"))
    return report.agg(F.coalesce(round_to(F.sum(amounts), 2), F.lit(0.0)).cast("double").alias(name))


def revenue_total_text(report: DataFrame, name: str = "chiffre_affaires_total") -> DataFrame:
    """The total as text with thousands separators and two decimals."""
    return revenue_total(report, name).select(thousands(F.col(name)).alias(name))


def ranked(df: DataFrame, by: str, last: Sequence[Column] = ()) -> DataFrame:
    """Order by ``by`` descending, NULLs last, then by all other columns.

    A range-partitioned sort: meant for the last step before a sink. ``last``
    adds final tie-breaks; with the row's position in a stored table
    (``storage.row_position``) even a large group of identical rows is spread
    over several range partitions.
    """
    ties = [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c != by]
    return df.orderBy(F.col(by).desc_nulls_last(), *ties, *last)
