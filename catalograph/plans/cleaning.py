"""From raw tables to clean ones, in the two ways the job has known."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from catalograph.operators.clean import drop_blank_keys, drop_null_keys, keep_type
from catalograph.operators.dedupe import dedupe, dedupe_if_duplicated, dedupe_keep_first
from catalograph.operators.profile import dup_profile
from catalograph.schema import (
    KEY_COLUMNS,
    LINK_TABLE,
    LISTING_TABLE,
    MASTER_TABLE,
    TABLES,
    present_columns,
    rename_if_present,
)
from catalograph.sources import (
    GAPS,
    SUFFIXES,
    archive_entries,
    archive_gaps,
    archive_index,
    is_readable,
    listed_files,
    open_anywhere,
    read_archives,
    read_entries,
    workbook_rows,
    workbook_table,
)
from catalograph.sources.ranged import Opener
from catalograph.storage import stored

LINK_KEYS = ("id_web", "product_id")


@dataclass(frozen=True)
class Catalog:
    """The three tables: product master, link, web listing."""

    master: DataFrame
    link: DataFrame
    listing: DataFrame

    def named(self) -> list[tuple[str, DataFrame]]:
        return [(MASTER_TABLE, self.master), (LINK_TABLE, self.link), (LISTING_TABLE, self.listing)]


POSITION = ("archive", "entry", "row_idx")


class IncompleteArchives(ValueError):
    """Archives that lack a workbook of a table."""


NAMED = 10  # gaps that an error message names


def require_complete(index: DataFrame, below: str) -> None:
    """Raise :class:`IncompleteArchives` if an archive lacks a workbook that can be read for one of the three
    tables, or if there is no archive. Runs one job over the index."""
    if index.isEmpty():
        raise IncompleteArchives(f"no workbook for {', '.join(TABLES)} below {below}")
    gaps = archive_gaps(index, list(TABLES), SUFFIXES).where(F.col("problem").isin(*GAPS))
    found = gaps.orderBy("archive", "table_name").take(NAMED + 1)
    if found:
        only = lambda r: f" (only {r['other']}, not {' or '.join(SUFFIXES)})" if r["other"] else ""
        texts = [f"no workbook for {r['table_name']} in {r['archive']}{only(r)}" for r in found[:NAMED]]
        raise IncompleteArchives("; ".join(texts) + ("; and more" if len(found) > NAMED else ""))


def read_catalog(
    spark: SparkSession,
    path: str | Sequence[str],
    rest: str | None = "other_cells",
    keep_position: bool = False,
    strict: bool = True,
    complete: bool = True,
    work: str | None = None,
    open_file: Opener | None = open_anywhere,
) -> Catalog:
    """The three raw tables from all archives of workbooks below ``path``.

    Only the archives' directories are read to plan; a table then reads the byte ranges of its own workbooks.
    With a shared folder ``work`` the index of all entries is stored there, so no byte of
    an archive is read twice; without it directories are read again for each table. ``open_file`` opens a
    path in a task; None leaves reading to Spark, which takes whole archives, for stores that only
    it can reach.

    With ``complete`` an archive that lacks a workbook of a table is an error that names it, old formats
    included; :func:`archive_gaps` of the index lists all. Without it the other archives' rows are used. Cells of
    columns that no schema declares go to the map column ``rest`` (None: left out).
    ``keep_position`` keeps ``archive``, ``entry`` and ``row_idx``, the input order that
    ``clean_by_first`` can follow. Write the tables before using them more than once.
    """
    if open_file is None:
        archives = read_archives(spark, path)
        listed = archive_entries(archives, content=False)
        empty = archives.select(F.col("path").alias("archive"), *[F.lit(None).cast("string").alias(c) for c in ("entry", "table_name")])
        index = listed.unionByName(empty)
    else:
        index = archive_index(listed_files(spark, path, "*.zip"), open_file)
        if work is not None:
            index = stored(index, work, "archive-index")
    if complete:
        require_complete(index, str(path))

    def read(name: str) -> DataFrame:
        if open_file is None:
            rows = workbook_rows(archive_entries(archives, [name], SUFFIXES))
        else:
            own = index.where((F.col("table_name") == name) & is_readable(F.col("entry"), SUFFIXES))
            rows = workbook_rows(read_entries(own, open_file), spread=False)
        table = workbook_table(rows, name, TABLES[name], rest=rest, strict=strict)
        return table if keep_position else table.drop(*POSITION)

    return Catalog(read(MASTER_TABLE), read(LINK_TABLE), read(LISTING_TABLE))


def profile(raw: Catalog) -> dict[str, Row]:
    """Rows, distinct keys and duplicates of master and link, one row each. One pass over their keys."""
    names = ("total", "distinct", "duplicates")
    return {
        MASTER_TABLE: dup_profile(raw.master, ["product_id"], ignore_null_keys=True, names=names).take(1)[0],
        LINK_TABLE: dup_profile(raw.link, LINK_KEYS, ignore_null_keys=False, names=names).take(1)[0],
    }


def clean(raw: Catalog, keep_undoubled_nulls: bool = True, profiles: Mapping[str, Row] | None = None) -> Catalog:
    """Current rules.

    Master and link are de-duplicated by key, the listing loses blank keys and
    other types but keeps rows without a type and repeated keys.

    A master or link table without any duplicate keeps its NULL keys. Inner
    joins drop those rows anyway, so a plan that only joins the result may pass
    ``keep_undoubled_nulls=False`` and save the duplicate profile. So may one that has made
    it (:func:`profile`) and passes it as ``profiles``.
    """
    if keep_undoubled_nulls:
        known = {name: row["duplicates"] for name, row in (profiles or {}).items()}
        master = dedupe_if_duplicated(raw.master, ["product_id"], duplicates=known.get(MASTER_TABLE))
        link = dedupe_if_duplicated(raw.link, LINK_KEYS, count_null_keys=True, duplicates=known.get(LINK_TABLE))
    else:
        master = dedupe(raw.master, ["product_id"])
        link = dedupe(raw.link, LINK_KEYS)
    return Catalog(master, link, keep_type(drop_blank_keys(raw.listing)))


def clean_by_first(df: DataFrame, sequence: str | Sequence[str]) -> DataFrame:
    """Former rules, the same for each table: the steps apply to the columns it has.

    Rename ``sku``, drop NULL keys, keep only products (a missing type is not
    one), keep the first row per key in the order of ``sequence``.
    """
    df = drop_null_keys(rename_if_present(df))
    if "post_type" in df.columns:
        df = keep_type(df, keep_null=False)
    keys = present_columns(df, KEY_COLUMNS)
    return dedupe_keep_first(df, keys, sequence) if keys else df
