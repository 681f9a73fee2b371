"""The shipped checks notice when a step does nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalograph.plans import cleaning
from queries import catalog

SF_DIR = "/root/testdata/sf0.001"


def verdicts(spark):
    return {r.check_name: r.passed for r in catalog.q_checks(spark, SF_DIR).collect()}


def test_all_but_the_fan_out_pass(spark):
    assert [name for name, ok in verdicts(spark).items() if not ok] == ["report_rows"]


@pytest.mark.parametrize(
    ("module", "step", "check"),
    [(cleaning, "keep_type", "web_type_rows"), (catalog, "drop_blank_keys", "web_nonblank_rows"), (catalog, "with_segment", "premium_rows")],
)
def test_a_step_that_does_nothing_is_noticed(spark, monkeypatch, module, step, check):
    def nothing(df, *_, **__):
        return df.withColumn("segment", F.lit("premium")) if step == "with_segment" else df

    monkeypatch.setattr(module, step, nothing)
    assert not verdicts(spark)[check]
