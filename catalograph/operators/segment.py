"""Price z-score over the whole joined set, and the premium / ordinary split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.functions import finite, round_to
from catalograph.functions.exact import exact_deviation, exact_mean

THRESHOLD = 2.0
RAW_SCORE = "_z"
PREMIUM = "premium"
ORDINARY = "ordinary"


def with_raw_score(df: DataFrame, column: str, name: str = RAW_SCORE, exact: bool = False) -> DataFrame:
    """Add the unrounded z-score of ``column`` over all rows of ``df``.

    Mean and sample deviation come from one aggregate, read back as a scalar
    subquery: no single-partition window and no join. They are taken before
    any later filter, over finite values only. The score is NULL when the value is
    NULL, NaN or infinite, when there is one row, or when the deviation is zero.

    ``df`` is read twice, so pass a stored table rather than a long plan. With ``exact`` it is read three times, and
    scores are the same bits however the rows are dealt to tasks (:mod:`catalograph.functions.exact`).
    """
    value = finite(F.col(column))
    if exact:
        mean = exact_mean(df, column)
        return df.withColumn(name, F.try_divide(value - mean, exact_deviation(df, column, mean)))
    stats = df.agg(F.struct(F.avg(value).alias("mean"), F.stddev_samp(value).alias("dev")).alias("s")).scalar()
    z = F.try_divide(value - stats["mean"], stats["dev"])
    return df.withColumn(name, z)


def displayed(scored: DataFrame, after: str = "prix_unitaire") -> DataFrame:
    """Replace the raw score by ``z_score``, rounded to 4 places, right after the price."""
    out: list[Column] = []
    for c in scored.columns:
        if c != RAW_SCORE:
            out.append(F.col(f"`{c}`"))
        if c == after:
            out.append(round_to(F.col(RAW_SCORE), 4).alias("z_score"))
    return scored.select(*out)


def price_scores(report: DataFrame, column: str = "prix_unitaire") -> DataFrame:
    """The report with its rounded ``z_score``."""
    return displayed(with_raw_score(report, column), column)


def premium(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows whose unrounded score is above the threshold."""
    return scored.where(F.col(RAW_SCORE) > threshold)


def ordinary(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows whose unrounded score is at most the threshold; a NULL score is in neither part."""
    return scored.where(F.col(RAW_SCORE) <= threshold)


def with_segment(scored: DataFrame, threshold: float = THRESHOLD, name: str = "segment") -> DataFrame:
    """Label each row premium, ordinary or NULL, to write both parts in one pass."""
    z = F.col(RAW_SCORE)
    return scored.withColumn(name, F.when(z > threshold, PREMIUM).when(z <= threshold, ORDINARY))
