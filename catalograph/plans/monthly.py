"""The monthly run: raw tables in, clean tables, reports, checks and log out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from catalograph.functions import finite, round_to
from catalograph.operators.checks import Check, Watch, check_lines, count_lines, joined_log, metric_rows, run_checks
from catalograph.operators.clean import drop_blank_keys, listing_rules, with_reasons, write_routed
from catalograph.operators.joins import heavy_keys, join_sizes, require_fan_out
from catalograph.operators.report import ranked, revenue_report, revenue_total
from catalograph.operators.segment import ORDINARY, PREMIUM, displayed, with_raw_score, with_segment
from catalograph.plans.cleaning import LINK_KEYS, Catalog, clean, profile
from catalograph.schema import LINK_TABLE, LISTING_TABLE, MASTER_TABLE
from catalograph.sinks import write_csv, write_one_csv, write_parquet
from catalograph.sources import load_table
from catalograph.storage import remove, row_position


@dataclass(frozen=True)
class Expectations:
    """Expected figures of a run; the defaults are those of the original catalog."""

    # The figures the original data set must give. A column, such as
    # a scalar aggregate of another table, may stand in for a figure.
    master_rows: float | Column = 825
    link_rows: float | Column = 825
    listing_keyed_rows: float | Column = 1428
    listing_rows: float | Column = 714
    report_rows: float | Column = 714
    revenue: float | Column = 70568.60
    premium_rows: float | Column = 30


CHECK_NAMES = (
    "erp_rows",
    "link_rows",
    "web_nonblank_rows",
    "web_type_rows",
    "report_rows",
    "revenue_total",
    "premium_rows",
)


def catalog_checks(
    cleaned: Catalog, keyed_listing: DataFrame, report: DataFrame, segments: DataFrame, expected: Expectations
) -> DataFrame:
    """The seven checks, one pass per table.

    ``keyed_listing`` is the listing without blank keys, before its type filter.
    """
    rows = F.count("*")
    # Without duplicates the master keeps its NULL keys, which do not count here.
    keyed_masters = F.count("product_id")
    total = F.coalesce(round_to(F.sum(finite(F.col("chiffre_affaires"))), 2), F.lit(0.0))
    return run_checks(
        [
            (cleaned.master, [Check("erp_rows", expected.master_rows, keyed_masters)]),
            (cleaned.link, [Check("link_rows", expected.link_rows, rows)]),
            (keyed_listing, [Check("web_nonblank_rows", expected.listing_keyed_rows, rows)]),
            (cleaned.listing, [Check("web_type_rows", expected.listing_rows, rows)]),
            (
                report,
                [
                    Check("report_rows", expected.report_rows, rows),
                    Check("revenue_total", expected.revenue, total),
                ],
            ),
            (segments, [Check("premium_rows", expected.premium_rows, F.count_if(F.col("segment") == PREMIUM))]),
        ]
    )


def stage_metrics(raw: Catalog, cleaned: Catalog, report: DataFrame) -> DataFrame:
    """(step, metric, value): rows read, duplicates found, rows kept. One pass per table."""
    rows = F.count("*")
    keyed, keys = F.count("product_id"), F.count_distinct("product_id")
    pairs = F.count_distinct(F.struct(*LINK_KEYS))
    parts = [
        metric_rows(
            raw.master,
            [
                (f"read {MASTER_TABLE}", "rows", rows),
                (f"profile {MASTER_TABLE}", "total", keyed),
                (f"profile {MASTER_TABLE}", "distinct", keys),
                (f"profile {MASTER_TABLE}", "duplicates", keyed - keys),
            ],
        ),
        metric_rows(
            raw.link,
            [
                (f"read {LINK_TABLE}", "rows", rows),
                (f"profile {LINK_TABLE}", "total", rows),
                (f"profile {LINK_TABLE}", "distinct", pairs),
                (f"profile {LINK_TABLE}", "duplicates", rows - pairs),
            ],
        ),
        metric_rows(raw.listing, [(f"read {LISTING_TABLE}", "rows", rows)]),
        *[metric_rows(df, [(f"clean {name}", "rows", rows)]) for name, df in cleaned.named()],
        metric_rows(
            report,
            [("report", "rows", rows), ("report", "revenue", round_to(F.sum(finite(F.col("chiffre_affaires"))), 2))],
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def watched_metrics(watch: Watch, profiles: Mapping[str, Row], spark: SparkSession) -> DataFrame:
    """(step, metric, value): :func:`stage_metrics` from figures gathered while the tables were written, and the
    profiles that cleaning needed anyway. Reads no table."""
    found = [(f"profile {name}", figure, float(row[figure])) for name, row in profiles.items() for figure in ("total", "distinct", "duplicates")]
    return watch.rows(spark).unionByName(spark.createDataFrame(found, "step string, metric string, value double"))


def run_month(
    raw: Catalog,
    out: str,
    expected: Expectations = Expectations(),
    copy_raw: bool = True,
    one_file: bool = False,
    keep_rejected: bool = False,
    most_fan_out: float | None = None,
) -> dict[str, DataFrame]:
    """Run everything and write it below ``out``, a folder all executors share.

    Each table is written once and read back before it is used again, so no
    join or de-duplication runs twice and a lost executor never replays the
    whole plan. ``copy_raw=False`` is for raw tables that are stored already. Row counts and
    the revenue of the run's metrics are taken while tables are written. Total and scores are
    the same bits in every run over the same rows.

    ``one_file`` writes every report as one ordered CSV file instead of a folder of parts. ``keep_rejected``
    also keeps the listing rows that cleaning removes, with the reasons, as table ``rejected``. ``most_fan_out`` stops
    the run before the joins if they would give more rows than that per link.
    Returns the written tables by name.
    """
    spark = raw.master.sparkSession
    folder = out.rstrip("/")
    watch = Watch()
    rows = F.count("*")

    def keep(df: DataFrame, name: str, partition_by: str | None = None, step: str | None = None, **figures: Column) -> DataFrame:
        watched = watch.on(df, step, **figures) if step else df
        write_parquet(watched, f"{folder}/{name}", partition_by)
        return load_table(spark, folder, name, df.schema)

    if copy_raw:
        raw = Catalog(*(keep(df, f"raw/{name}", step=f"read {name}", rows=rows) for name, df in raw.named()))
    profiles = profile(raw)
    kept = clean(raw, profiles=profiles)
    others = {}
    if keep_rejected:
        tagged = with_reasons(raw.listing, listing_rules())
        remove(spark, f"{folder}/routed")
        listing, others["rejected"] = write_routed(tagged, f"{folder}/routed")
        kept = Catalog(kept.master, kept.link, listing)
    cleaned = Catalog(*(keep(df, f"clean/{name}", step=f"clean {name}", rows=rows) for name, df in kept.named()))
    if most_fan_out is not None:
        require_fan_out(join_sizes(cleaned.link, cleaned.master, cleaned.listing), most_fan_out)

    heavy = keep(heavy_keys(cleaned.link, "product_id"), "heavy")
    joined = revenue_report(cleaned.master, cleaned.link, cleaned.listing, heavy)
    revenue = round_to(F.sum(finite(F.col("chiffre_affaires"))), 2)
    report = keep(joined, "report", step="report", rows=rows, revenue=revenue)
    total = keep(revenue_total(report, exact=True), "total")
    # Scored once: both parts come from the same mean and deviation.
    scored = with_raw_score(report, "prix_unitaire", exact=True)
    segments = keep(displayed(with_segment(scored)), "segments", "segment")

    def export(df: DataFrame, name: str) -> None:
        if one_file:
            write_one_csv(df, f"{folder}/csv/{name}.csv")
        else:
            write_csv(df, f"{folder}/csv/{name}")

    export(ranked(report, "chiffre_affaires", row_position(report)), "report")
    export(total, "total")
    for name in (PREMIUM, ORDINARY):
        part = segments.where(F.col("segment") == name).drop("segment")
        export(ranked(part, "z_score", row_position(part)), name)

    checks = keep(catalog_checks(cleaned, drop_blank_keys(raw.listing), report, segments, expected), "checks")
    found = watched_metrics(watch, profiles, spark)
    if not copy_raw:
        found = found.unionByName(reduce(DataFrame.unionByName, [metric_rows(df, [(f"read {name}", "rows", rows)]) for name, df in raw.named()]))
    metrics = keep(found, "metrics")
    counts = count_lines(raw.named())
    verdicts = check_lines(checks, CHECK_NAMES, first_step=len(raw.named()) + 1)
    log = keep(joined_log(counts.unionByName(verdicts)), "log")
    return {
        **dict(cleaned.named()),
        "report": report,
        "total": total,
        "segments": segments,
        "checks": checks,
        "metrics": metrics,
        "log": log,
        **others,
    }
