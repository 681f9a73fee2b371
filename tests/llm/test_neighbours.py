"""Nearest-neighbour votes: terms and cosines against plain versions, and held-out accuracy."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from awkward import awkward, empty
from pyspark.sql import functions as F

from catalograph.llm import neighbours, queries


def plain_counts(text):
    text = text or ""
    shape = []
    for byte in text.encode():
        mark = next((k for k, chars in enumerate(neighbours._MARKS) if byte < 128 and chr(byte) in chars), 0)
        if not shape or mark >= 4 or shape[-1] != mark:
            shape.append(mark)
    out = Counter()
    for a, b, c, d in zip(shape, shape[1:], shape[2:], shape[3:]):
        out[((a * 4096 + b * 256 + c * 16 + d) * 2654435761 % 2**32) >> 20] += 1
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    for k, n in enumerate([sum(a == b for a, b in zip(words, words[1:])), sum(a == b for a, b in zip(words, words[2:])), len(lines) - len(set(lines))]):
        out[neighbours.BUCKETS + k] = n * neighbours.REPEATED
    return {k: n for k, n in out.items() if n}


def found_counts(text):
    counts = neighbours.term_counts(text)
    return {int(k): counts[k] for k in np.flatnonzero(counts)}


TEXTS = [None, "", " ", "a", "aa bb aa bb bb", "A!! B!! ###", "line\nline\n\nline", "Größe Ñandú 12 3\tx", "x | y | z.", "na na na " * 50]


@pytest.mark.parametrize("part", [4, 11, 1 << 20])
def test_terms(monkeypatch, part):
    monkeypatch.setattr(neighbours, "PART", part)
    rng = random.Random(part)
    spaced = [" ".join(rng.choices(["a", "B!", "c,", "7", "é", "x\ny", "|"], k=60)) for _ in range(30)]
    for text in [t for t in TEXTS if part > 100 or not t or max(map(len, t.split(" ")), default=0) < part - 1] + (spaced if part > 4 else []):
        assert found_counts(text) == plain_counts(text), text


def test_votes_are_exact():
    """Scores against cosines computed one by one."""
    rng = np.random.default_rng(2)
    counts = rng.poisson(0.4, (60, 40)).astype(float)
    counts[50:] = counts[:10]  # ties
    labels, weights = (rng.random(60) < 0.6).astype(float), rng.integers(1, 4, 60).astype(float)
    model = neighbours.fitted(counts, labels, weights, 0.7, dimensions=8)
    assert np.allclose(model.directions.T @ model.directions, np.eye(8), atol=1e-8)
    asked = rng.poisson(0.4, (20, 40)).astype(float)
    asked[0] = 0
    for own, score in zip(asked, model.score(asked)):
        mine = model.embed(own[None])[0]
        cosines = [float(sum(a * b for a, b in zip(mine, v))) for v in model.vectors]
        last = sorted(cosines)[-neighbours.NEIGHBOURS]
        votes = [(max(c, 0) * w, y) for c, w, y in zip(cosines, weights, labels) if c >= last - 1e-9]
        total = sum(v for v, _ in votes)
        assert math.isclose(score, sum(v * y for v, y in votes) / total if total > 0 else 0.7, abs_tol=1e-6)


def test_latent_directions_are_the_leading_ones():
    rng = np.random.default_rng(3)
    matrix = rng.standard_normal((80, 50)) * np.linspace(5, 0.1, 50) ** 2
    expected = np.linalg.svd(matrix)[1][:6]
    assert np.allclose(np.linalg.norm(matrix @ neighbours.decomposed(matrix, 6), axis=0), expected, rtol=1e-3)


def test_awkward(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(0, 1), (4, 1), (5, 1), (5, 0), (9, 0), (9, 0), (3, None), (None, 1), (99, 1)], "doc_id long, label int")
    out = neighbours.classified(docs, neighbours.train(docs, labels, "doc_id")).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    scores = {r.doc.doc_id: r.score for r in out}
    assert scores[0] > 0.5 > scores[9] and scores[10] == scores[11]
    assert {scores[1], scores[2]} == {3 / 5}  # of five labelled keys three have label 1 at least
    assert out[0].doc.asDict().keys() == set(docs.columns)
    untold = neighbours.train(docs, labels.limit(0), "doc_id")
    assert {r.score for r in neighbours.classified(docs, untold).collect()} == {0.5}
    assert neighbours.classified(empty(spark), untold).count() == 0
    one = neighbours.train(docs, labels.where("label = 1"), "doc_id")
    assert {r.score for r in neighbours.classified(docs, one).collect()} == {1.0}


def test_sample_is_bounded_and_has_both_labels(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    docs = docs.unionByName(docs.where("doc_id < 40"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 30, 0).otherwise(1).alias("label"))
    model = neighbours.train(docs, labels, "doc_id", sample=100)
    assert len(model.vectors) <= 100 and (model.labels == 0).sum() >= 20
    assert math.isclose(model.prior, 370 / 400)
    assert math.isclose(model.weights[model.labels == 0].sum(), 30) and math.isclose(model.weights[model.labels == 1].sum(), 370)


def test_held_out(spark):
    """Rows that the model has never seen, at a size where labels of all kinds are there."""
    sf = "/root/testdata/sf0.1"
    out = queries.op13_quality_classifier(spark, sf)
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    found = {r.doc_id: r for r in out.collect()}
    assert len(found) == 10_000
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(found[i], y) for i, y in labels.items() if i in found and found[i].held_out]
    for y, least in ((0, 0.97), (1, 0.99)):
        own = [r.predicted == y for r, label in held if label == y]
        assert len(own) > 100 and sum(own) / len(own) >= least
    assert all(r.predicted == int(r.score >= 0.3) for r in found.values())
