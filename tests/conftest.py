from __future__ import annotations

import pytest

from catalograph.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test; the old values come back afterwards."""
    old: dict[str, str | None] = {}

    def change(**settings):
        for key, value in settings.items():
            name = key.replace("__", ".")
            old.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, str(value))

    yield change
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def final_plan(df) -> str:
    """Run the frame and return the plan adaptive execution ended with, subqueries included."""
    df.collect()
    kept, skip_from = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        indent = len(line) - len(line.lstrip(" :"))
        if skip_from is not None and indent >= skip_from:
            continue
        skip_from = indent if "== Initial Plan ==" in line else None
        if skip_from is None:
            kept.append(line)
    return "\n".join(kept)
