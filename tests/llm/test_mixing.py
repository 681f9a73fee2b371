"""Mixing: targets against resharing step by step, the mix against one sorted queue."""

import hashlib
import random
from fractions import Fraction

import pytest
from awkward import awkward, awkward_rows, empty, words
from pyspark.sql import functions as F

from catalograph.llm import mixing


def reshared(sizes, mix):
    """Targets by resharing the excess by weight until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: Fraction(mix.weights[k % len(mix.weights)]) for k, s in enumerate(names)}
    cap = {s: Fraction(mix.rounds) * sizes[s] for s in names}
    left, target = Fraction(mix.budget) * sum(sizes.values()), dict.fromkeys(names, Fraction(0))
    open_ = [s for s in names if cap[s] > 0]
    while left > 0 and open_:
        share = left / sum(weight[s] for s in open_)
        left = Fraction(0)
        for s in open_:
            target[s] += share * weight[s]
            if target[s] > cap[s]:
                left += target[s] - cap[s]
                target[s] = cap[s]
        open_ = [s for s in open_ if target[s] < cap[s]]
    return target


def brute(rows, mix):
    """(id, source, size) -> (id, size, source_size, target, taken)."""
    total = {}
    for _, s, n in rows:
        total[s] = total.get(s, 0) + n
    target = reshared(total, mix)
    md5 = lambda i: hashlib.md5(("null" if i is None else str(i)).encode()).hexdigest()
    queue = []
    for s in total:
        upto = 0
        for k, (i, _, n) in sorted(enumerate(r for r in rows if r[1] == s), key=lambda x: (md5(x[1][0]), x[1][2])):
            upto += n
            for turn in range(mix.rounds if n else 1):
                finish = float(upto + turn * total[s]) / float(target[s]) if target[s] else 0.0
                queue.append((finish, s or "", s is None, md5(i), n, turn, (s, k)))
    taken, spent = {}, 0
    for *_, n, _, place in sorted(queue, key=lambda q: q[:6]):
        spent += n
        if spent <= mix.budget * sum(total.values()):
            taken[place] = taken.get(place, 0) + n
    out = []
    for s in total:
        for k, (i, _, n) in enumerate(r for r in rows if r[1] == s):
            out.append((i, n, total[s], float(target[s]), taken.get((s, k), 0)))
    return out


def plan(df, mix=mixing.Mix()):
    out = mixing.mix_plan(df, F.col("size"), F.col("source"), F.col("doc_id"), mix)
    return [tuple(r) for r in out.select("doc.doc_id", "size", "source_size", "target", "taken").collect()]


def close(rows):
    return sorted(((i, n, s, round(t, 6), taken) for i, n, s, t, taken in rows), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_against_one_queue(spark, monkeypatch, seed):
    monkeypatch.setattr(mixing, "STEPS", 7)
    monkeypatch.setattr(mixing, "CELL_DIGITS", 1)
    rng = random.Random(seed)
    names = [None, "a", "b", "Z", "ä", "zz", ""][: 2 + seed + 1]
    rows = [(i, rng.choices(names, [9, *[1] * (len(names) - 1)])[0], rng.choice([0, 1, 5, 100, 3000])) for i in range(300)]
    mix = mixing.Mix((5.0, 2.0, 1.0), rng.choice([0.5, 1.5, 2.0]), rng.choice([2, 3]))
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    assert close(plan(df, mix)) == close(brute(rows, mix))


def test_awkward(spark):
    df = awkward(spark)
    out = mixing.mix_plan(df, mixing.word_count(F.col("text")), F.col("source"), F.col("doc_id"))
    got = [tuple(r) for r in out.select("doc.doc_id", "size", "source_size", "target", "taken").collect()]
    rows = [(r[0], r[3], len(words(r[1]))) for r in awkward_rows()]
    assert close(got) == close(brute(rows, mixing.Mix()))
    mixed = mixing.mixed(df, mixing.word_count(F.col("text")), F.col("source"), F.col("doc_id"))
    assert mixed.schema.names == df.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == sum(r[-1] for r in got)


def test_empty(spark):
    assert plan(empty(spark)) == []
    assert mixing.mixed(empty(spark), F.col("size"), F.col("source"), F.col("doc_id")).count() == 0


def test_reruns_agree_whatever_the_partitions(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    assert sorted(plan(df.repartition(7))) == sorted(plan(df.coalesce(1)))


def test_order_is_by_finish_time(spark):
    rows = [(i, "ab"[i % 2], 10) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = [r.source for r in mixing.mixed(df, F.col("size"), F.col("source"), F.col("doc_id")).collect()]
    # Targets are 400 and 200 words of 600: two of a for one of b all along.
    assert got.count("a") == 40 and got.count("b") == 20
    assert all(abs(got[:n].count("a") - 2 * n / 3) <= 1.5 for n in range(60))


def hot_rows():
    """A third of all rows without an id, a third with one id, some of them alike; null sizes count as 0."""
    rng = random.Random(5)
    ids = [None, 7, None]
    return [(ids[k % 3] if k % 3 < 2 else k, rng.choice(["a", "b", None]), rng.choice([0, 3, 3, 40]), f"t{k % 50}") for k in range(600)]


def test_one_id_holds_a_third(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, text string").repartition(6)
    assert close(plan(df)) == close(brute([r[:3] for r in rows], mixing.Mix()))
    mixed = mixing.mixed(df, F.col("size"), F.col("source"), F.col("doc_id")).collect()
    want = sum(r[-1] for r in brute([r[:3] for r in rows], mixing.Mix()))
    assert sum(r.size for r in mixed) == want
    assert set(rows) >= {tuple(r) for r in mixed}


def test_rows_of_one_id_are_numbered_in_lanes(spark):
    """Copies of a row meet neither in one group of counts nor in one group of rows."""
    df = spark.range(8000).select(F.lit(1).alias("doc_id"), F.lit("a").alias("source"), F.lit(5).cast("long").alias("size"))
    sized = mixing._sized(df, F.col("size"), F.col("source"), F.col("doc_id"), mixing._any_lane(df), False)
    lanes = [r["count"] for r in sized.groupBy("lane").count().collect()]
    assert len(lanes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(lanes) < 2 * min(lanes)
    assert sum(r[-1] for r in plan(df)) == 60000  # all of the budget goes to the one source


def test_texts_split_a_repeated_id(spark):
    df = spark.createDataFrame([(1, f"t{k}", {"x": k}) for k in range(800)], "doc_id long, text string, m map<string,int>")
    lanes = [r["count"] for r in df.groupBy(mixing._lane_by_content(df)).count().collect()]
    assert len(lanes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(lanes) < 300


def test_null_sizes_are_empty(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 10)], "doc_id long, source string, size long")
    assert {r[0]: r[1] for r in plan(df)} == {1: 0, 2: 10}
