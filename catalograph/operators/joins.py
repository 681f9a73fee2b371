"""Inner joins: spread where a few keys hold most of the rows, and counted before they run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = "_parts"


def heavy_keys(df: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """(key, _parts) of each key with more rows than an average task out of ``tasks``
    (default: the session's shuffle partitions).

    ``_parts`` is the number of average tasks its rows fill. Counts are exact and are
    combined before their shuffle. Fewer keys than ``tasks`` can be heavy, whatever
    the data, and all parts together are at most twice ``tasks``.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.where(F.col(f"`{key}`").isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    total = df.agg(F.count(f"`{key}`")).scalar()
    parts = F.ceil(F.col("_rows") * tasks / total).cast("int")
    return counts.where(F.col("_rows") * tasks > total).select(key, parts.alias(PARTS))


def spread_join(fact: DataFrame, dim: DataFrame, key: str, spread_by: Column, heavy: DataFrame | None = None) -> DataFrame:
    """``fact.join(dim, key)`` (inner) with the keys in ``heavy`` spread over several tasks.

    ``heavy`` is :func:`heavy_keys`'s result, of ``fact`` or of the table it was
    computed from: it only decides how rows are spread. The rows of a heavy key are
    parted by a hash of ``spread_by``, and its ``dim`` rows are repeated once per
    part; with one ``dim`` row per key that adds at most twice as many rows as there
    are tasks. Both inputs are shuffled for this join alone, so adaptive execution can
    split whatever is still uneven. Without ``heavy`` it is the plain join.
    """
    if heavy is None:
        return fact.join(dim, key, "inner")
    # Fewer rows than tasks, whatever the data: safe to broadcast.
    parts = F.broadcast(heavy)
    count = F.coalesce(PARTS, F.lit(1))
    parted = fact.join(parts, key, "left").withColumn("_part", F.pmod(F.xxhash64(spread_by), count).cast("int"))
    repeated = dim.join(parts, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), count - 1)))
    return parted.drop(PARTS).join(repeated.drop(PARTS), [key, "_part"], "inner").drop("_part")


def parted(df: DataFrame, key: str, heavy: DataFrame, spread_by: Column | None = None, name: str = "_part") -> DataFrame:
    """``df`` with the part of each row in column ``name``: 0, but for keys in ``heavy`` (:func:`heavy_keys`'s result).

    Their rows are dealt to parts by a hash of ``spread_by``, or without it repeated once per part, for the other side of
    a join by key and part.
    """
    count = F.coalesce(PARTS, F.lit(1))
    part = F.explode(F.sequence(F.lit(0), count - 1)) if spread_by is None else F.pmod(F.xxhash64(spread_by), count).cast("int")
    # Fewer rows than tasks, whatever the data: safe to broadcast.
    return df.join(F.broadcast(heavy), key, "left").withColumn(name, part).drop(PARTS)


def _per_key(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.where(F.col(f"`{key}`").isNotNull()).groupBy(key).agg(F.count("*").alias(name))


def join_sizes(link: DataFrame, master: DataFrame, listing: DataFrame, master_key: str = "product_id", listing_key: str = "id_web") -> DataFrame:
    """(master_key, listing_key, links, masters, listings, rows) of every pair of keys that the two joins match.

    ``rows`` is how many rows the pair gives: the product of its counts in the three tables. Only counts
    meet, one per key, combined before their shuffle; no row is joined, so a key that would fan out into
    billions of rows costs as much as any other.
    """
    links = link.where(F.col(f"`{master_key}`").isNotNull() & F.col(f"`{listing_key}`").isNotNull())
    pairs = links.groupBy(master_key, listing_key).agg(F.count("*").alias("links"))
    met = pairs.join(_per_key(master, master_key, "masters"), master_key).join(_per_key(listing, listing_key, "listings"), listing_key)
    rows = F.col("links").cast("decimal(38,0)") * F.col("masters") * F.col("listings")
    return met.select(master_key, listing_key, "links", "masters", "listings", rows.cast("decimal(38,0)").alias("rows"))


def predicted_rows(sizes: DataFrame) -> DataFrame:
    """One row: ``links`` that find both partners, ``rows`` the joins give, ``fan_out`` how many of these exceed one per
    link, ``keys`` how many pairs cause that."""
    none = F.lit(0).cast("decimal(38,0)")
    total = F.coalesce(F.sum("rows"), none)
    links = F.coalesce(F.sum("links"), F.lit(0).cast("long"))
    return sizes.agg(
        links.alias("links"),
        total.cast("decimal(38,0)").alias("rows"),
        (total - links).cast("decimal(38,0)").alias("fan_out"),
        F.count_if(F.col("rows") > F.col("links")).alias("keys"),
    )


def fan_out_keys(sizes: DataFrame) -> DataFrame:
    """The pairs of keys that give more rows than they have links."""
    return sizes.where(F.col("rows") > F.col("links"))


class FanOut(ValueError):
    """A join that would give more rows than allowed."""


def require_fan_out(sizes: DataFrame, most: float, named: int = 5) -> None:
    """Raise :class:`FanOut` before a join runs, if it gives more than ``most`` rows per link; the error names the pairs
    that add most. Runs one job over the counts, and another if it raises."""
    found = predicted_rows(sizes).take(1)[0]
    if found["rows"] > most * found["links"]:
        extra = F.col("rows") - F.col("links")
        worst = sizes.orderBy(extra.desc(), *[F.col(c) for c in sizes.columns[:2]]).take(named)
        pairs = ", ".join(f"({r[0]}, {r[1]}): {r['rows']} rows" for r in worst)
        raise FanOut(f"{found['links']} links give {found['rows']} rows, more than {most} each; {pairs}")
