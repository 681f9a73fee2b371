"""Expectation checks and the run log. Checks report; they never stop a run."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from catalograph.functions import thousands

TOLERANCE = 0.005  # half a cent: the order of a distributed sum is not fixed


@dataclass(frozen=True)
class Check:
    """Compare two values; each is an aggregate of the checked frame, a scalar or a number."""

    name: str
    expected: Column | float
    actual: Column | float


def run_checks(groups: Sequence[tuple[DataFrame, Sequence[Check]]], tolerance: float = TOLERANCE) -> DataFrame:
    """(check_name, expected, actual, passed), one row per check.

    All checks on one frame share one aggregate, hence one pass over it. A value
    that could not be computed (NULL) fails its check.
    """
    parts = []
    for df, checks in groups:
        values = []
        for i, check in enumerate(checks):
            values.append(F.lit(check.expected).cast("double").alias(f"e{i}"))
            values.append(F.lit(check.actual).cast("double").alias(f"a{i}"))
        rows = F.array(
            *[
                F.struct(
                    F.lit(check.name).alias("check_name"),
                    F.col(f"e{i}").alias("expected"),
                    F.col(f"a{i}").alias("actual"),
                )
                for i, check in enumerate(checks)
            ]
        )
        parts.append(df.agg(*values).select(F.inline(rows)))
    close = F.abs(F.col("expected") - F.col("actual")) < tolerance
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.coalesce(close, F.lit(False)))


def metric_rows(df: DataFrame, metrics: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """(step, metric, value) rows; all metrics, given as (step, name, aggregate), share one pass over ``df``."""
    values = df.agg(*[value.cast("double").alias(f"v{i}") for i, (_, _, value) in enumerate(metrics)])
    rows = [
        F.struct(F.lit(step).alias("step"), F.lit(name).alias("metric"), F.col(f"v{i}").alias("value"))
        for i, (step, name, _) in enumerate(metrics)
    ]
    return values.select(F.inline(F.array(*rows)))


@dataclass
class Watch:
    """Figures that are gathered while frames are written: no pass of their own.

    :meth:`on` gives the frame to write; when it has been written, :meth:`rows` has its figures. A task that is
    tried again counts once, as Spark takes the figures of the attempt that ends well.
    """

    seen: list[tuple[str, dict[str, Column], Observation]] = field(default_factory=list)

    def on(self, df: DataFrame, step: str, **figures: Column) -> DataFrame:
        """``df``, whose ``figures`` (aggregates) are noted under ``step`` when it is written."""
        observation = Observation(f"{step}-{uuid.uuid4().hex}")
        self.seen.append((step, figures, observation))
        return df.observe(observation, *[value.cast("double").alias(name) for name, value in figures.items()])

    def figures(self) -> dict[tuple[str, str], float | None]:
        """By step and name. Waits for frames that have not been written yet."""
        return {(step, name): seen.get.get(name) for step, names, seen in self.seen for name in names}

    def rows(self, spark: SparkSession) -> DataFrame:
        """(step, metric, value) of all frames watched."""
        found = [(step, name, value) for (step, name), value in self.figures().items()]
        return spark.createDataFrame(found, "step string, metric string, value double")


def count_lines(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(step, msg): ``name: row count`` per table, numbered in the order given."""
    lines = [
        df.agg(F.count("*").cast("string").alias("n")).select(
            F.lit(i).alias("step"), F.concat(F.lit(f"{name}: "), "n").alias("msg")
        )
        for i, (name, df) in enumerate(tables, start=1)
    ]
    return reduce(DataFrame.unionByName, lines)


def check_lines(checks: DataFrame, names: Sequence[str], first_step: int = 1) -> DataFrame:
    """(step, msg): one line per check, in the order of ``names``."""
    outcome = F.when(F.col("passed"), "ok").otherwise("FAILED")
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("check_name")).cast("int")
    found = F.coalesce(thousands(F.col("actual")), F.lit("nothing"))
    return checks.select(
        (place + (first_step - 1)).alias("step"),
        F.concat("check_name", F.lit(": expected "), thousands(F.col("expected")), F.lit(", found "), found,
                 F.lit(", "), outcome).alias("msg"),
    )


def joined_log(lines: DataFrame, name: str = "pipeline_log") -> DataFrame:
    """One row: the messages in step order, one per line.

    ``lines`` holds one row per step of a run, a number fixed by the code.
    """
    return lines.agg(F.expr(r"listagg(msg, '\n') WITHIN GROUP (ORDER BY step)").alias(name))
