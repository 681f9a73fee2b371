"""Properties on random tables, against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from catalograph.operators.dedupe import dedupe, dedupe_if_duplicated, dedupe_keep_first
from catalograph.operators.profile import dup_profile
from catalograph.operators.report import revenue_report
from catalograph.operators.segment import RAW_SCORE, ordinary, premium, with_raw_score
from catalograph.schema import LINK, LISTING, MASTER

KEYS = ["id_web", "product_id"]
SEEDS = range(3)


def random_pairs(seed: int, clean: bool = False):
    r = random.Random(seed)
    pairs = [(r.choice([None, *range(12)]), r.choice([None, "", "a", "b", "c"])) for _ in range(60)]
    return list(dict.fromkeys(pairs)) if clean else pairs


@pytest.mark.parametrize("seed", SEEDS)
def test_dedupe_is_idempotent_and_complete(spark, seed):
    data = random_pairs(seed)
    once = dedupe(spark.createDataFrame(data, LINK), KEYS)
    assert rows(once) == rows(dedupe(once, KEYS))
    assert rows(once) == sorted({p for p in data if None not in p}, key=repr)


@pytest.mark.parametrize("seed", SEEDS)
def test_profile_tells_what_dedupe_removes(spark, seed):
    data = [p for p in random_pairs(seed) if None not in p]
    df = spark.createDataFrame(data, LINK)
    found = dup_profile(df, KEYS, ignore_null_keys=False).first()
    assert found.nb_doublons == len(data) - dedupe(df, KEYS).count() == len(data) - len(set(data))


@pytest.mark.parametrize("clean", [True, False])
@pytest.mark.parametrize("seed", SEEDS)
def test_gate_equals_the_branch(spark, seed, clean):
    data = random_pairs(seed, clean)
    df = spark.createDataFrame(data, LINK)
    expected = data if clean else {p for p in data if None not in p}
    assert rows(dedupe_if_duplicated(df, KEYS, count_null_keys=True)) == sorted(expected, key=repr)
    # The same with a further column, which takes the other plan.
    wide = df.withColumn("note", F.lit("n"))
    assert rows(dedupe_if_duplicated(wide, KEYS, count_null_keys=True)) == sorted(
        ((*p, "n") for p in expected), key=repr
    )


@pytest.mark.parametrize("seed", SEEDS)
def test_keep_first_equals_a_loop(spark, seed):
    r = random.Random(seed)
    data = [(i, r.choice([None, 1, 2, 3]), r.choice([None, "x", "y"])) for i in range(50)]
    first: dict = {}
    for row in data:
        first.setdefault(row[1:], row)
    shuffled = r.sample(data, len(data))
    df = spark.createDataFrame(shuffled, "seq long, a long, b string")
    assert rows(dedupe_keep_first(df, ["a", "b"], "seq")) == sorted(first.values(), key=repr)


@pytest.mark.parametrize("seed", SEEDS)
def test_report_and_split_equal_loops(spark, seed):
    r = random.Random(seed)
    ids, web_ids = range(10), "abcde"
    master = [(r.choice([None, *ids]), r.choice([None, 1.0, 2.5, 99.0]), r.randrange(5)) for _ in range(15)]
    link = [(r.choice([None, *ids]), r.choice([None, *web_ids])) for _ in range(30)]
    listing = [(r.choice([None, *web_ids]), "product", f"t{i}", r.choice([None, 0.0, 3.0])) for i in range(12)]
    expected = Counter(
        (m[0], k[1], w[2], m[1], w[3] or 0.0, None if m[1] is None else round(m[1] * (w[3] or 0.0), 2), m[2])
        for m in master
        for k in link
        for w in listing
        if m[0] is not None and m[0] == k[0] and k[1] is not None and k[1] == w[0]
    )
    report = revenue_report(
        spark.createDataFrame(master, MASTER),
        spark.createDataFrame(link, LINK),
        spark.createDataFrame(listing, LISTING),
    )
    assert Counter(tuple(x) for x in report.collect()) == expected
    scored = with_raw_score(report, "prix_unitaire")
    unscored = scored.where(F.col(RAW_SCORE).isNull()).count()
    assert premium(scored).count() + ordinary(scored).count() + unscored == sum(expected.values())
