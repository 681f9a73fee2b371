"""Quality rules: counts against brute force, certification against exact binomials."""

import math
import random
from collections import Counter

from awkward import awkward, awkward_rows, empty, words
from compare import connect, difference
from pyspark.sql import functions as F

from catalograph.llm import quality, queries

LABELS = "doc_id long, quality int, toxic int"


def brute(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {k + d for k, g in enumerate(zip(w, w[1:], w[2:])) if windows[g] > 1 for d in range(3)}
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        sum("A" <= c <= "Z" for c in text),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_repeat_words"]


def test_counts_of_awkward_texts(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) + rng.choice(["", "\n", "\nx\nx"]) for _ in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for frame, all_texts in ((awkward(spark), [r[1] for r in awkward_rows()]), (df, texts)):
        got = quality.with_counts(frame, F.col("text")).select(*COUNTS).collect()
        assert sorted(map(tuple, got)) == sorted(map(brute, all_texts))


def test_awkward_and_empty_verdicts(spark):
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (None, 1, None), (4, None, None)], LABELS)
    out = quality.quality_rules(awkward(spark), labels)
    assert out.count() == len(awkward_rows()) and out.schema["doc"].dataType.names == awkward(spark).columns
    assert quality.quality_rules(empty(spark), labels).count() == 0
    none = spark.createDataFrame([], LABELS)
    # Without labels nothing is certified: only the base rule rejects.
    assert quality.quality_rules(awkward(spark), none).where("kept = base_failed").count() == 0


def test_binomial_tail(spark):
    cases = [(n, k, p) for n in (1, 7, 60, 5000) for k in (0, 1, 5, 59) if k <= n for p in (0.01, 0.05, 0.5)]
    df = spark.createDataFrame(cases, "n long, k long, p double")
    for r in df.withColumn("tail", F.expr(quality.BINOMIAL)).collect():
        exact = math.fsum(math.exp(math.lgamma(r.n + 1) - math.lgamma(j + 1) - math.lgamma(r.n - j + 1) + j * math.log(r.p) + (r.n - j) * math.log1p(-r.p)) for j in range(r.k + 1))
        assert math.isclose(r.tail, min(1, exact), rel_tol=1e-9)


def _corpus(spark, n_good, n_junk, share_bad):
    """Good texts, some with symbols, and junk full of them, all labelled."""
    rng = random.Random(n_good)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    rows, labels = [], []
    for i in range(n_good + n_junk):
        junk = i >= n_good
        symbols = 1.0 if junk else (0.6 if rng.random() < share_bad else 0.0)
        rows.append((i, " ".join(word() + ("#" if rng.random() < symbols else "") for _ in range(80))))
        labels.append((i, int(not junk), 0))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)


def test_certified_rules_reject_junk_and_keep_good(spark):
    docs, labels = _corpus(spark, 1500, 60, 0.0)
    out = quality.quality_rules(docs, labels).select("doc.doc_id", "kept").collect()
    assert all(r.kept == (r.doc_id < 1500) for r in out)


def test_no_rule_without_enough_evidence(spark):
    docs, labels = _corpus(spark, 100, 40, 0.0)
    scored = quality.written(quality.with_counts(docs, F.col("text")), "counts")
    assert quality.cutoffs(scored, labels, "doc_id", "doc_id", "quality").count() == 0


def test_risk_holds(spark):
    """A tenth of the good documents has symbols: cut-offs that would reject them are not certified."""
    docs, labels = _corpus(spark, 2000, 200, 0.1)
    scored = quality.written(quality.with_counts(docs, F.col("text")), "counts")
    found = quality.cutoffs(scored, labels, "doc_id", "doc_id", "quality").collect()
    risk = quality.Risk()
    assert found and all(r.p_value <= risk.error / 12 and r.n_lost <= risk.risk * r.n_good for r in found)
    kept = quality.judged(scored, labels).where("kept").select("doc.doc_id").collect()
    assert sum(r.doc_id < 2000 for r in kept) >= 1990 and sum(r.doc_id >= 2000 for r in kept) == 0


def test_rules_together_certify_with_fewer_labels(spark):
    """Two hundred good documents in the holdout are enough for one test of the useful rules."""
    docs, labels = _corpus(spark, 400, 60, 0.0)
    scored = quality.written(quality.with_counts(docs, F.col("text")), "counts")
    found = quality.cutoffs(scored, labels, "doc_id", "doc_id", "quality").collect()
    assert [(r.stratum, r.rule, r.n_lost) for r in found] == [(0, 0, 0)] and found[0].p_value <= 0.1 / 3
    assert math.isclose(found[0].p_value, 0.96 ** found[0].n_good)
    assert all(r.kept == (r.doc_id < 400) for r in quality.judged(scored, labels).select("doc.doc_id", "kept").collect())


def test_certified_rules_reject_in_the_query(spark):
    """At sf0.01, where the twin is compared, a cut-off is certified and rejects documents that the base rule keeps."""
    out = queries.op5_quality_rules(spark, "/root/testdata/sf0.01")
    assert out.where("kept = base_failed").count() > 0


def test_long_documents_certify(spark):
    """At sf0.1, with SQL's verdicts for the query, every stratum certifies when rules are tested together."""
    sf = "/root/testdata/sf0.1"
    assert difference(queries.op5_quality_rules(spark, sf), connect(sf), queries.ORACLES["op5_quality_rules"]) is None
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    scored = quality.written(quality.with_counts(docs, F.col("text")), "counts")
    found = quality.cutoffs(scored, labels, "doc_id", "doc_id", "quality").collect()
    assert {r.stratum for r in found} == {0, 1, 2} and all(r.p_value <= 0.1 / 3 for r in found)
