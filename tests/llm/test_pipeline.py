"""Every stage against a brute-force version on its own input, and the whole run."""

import numpy as np
import pytest
from awkward import awkward, empty, words
from test_mixing import brute as brute_mix
from test_packing import ids_of
from test_quality import brute as brute_counts
from test_simhash import brute_components, brute_print
from test_substrings import brute as brute_substrings

import corpus_pipeline
from catalograph.llm import mixing, quality, stages

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_in_order():
    assert [f for _, f in corpus_pipeline.STAGES] == [stages.quality_rules, stages.near_duplicates, stages.substring_duplicates, stages.mix_sources, stages.pack_sequences]


def test_quality(spark, docs):
    kept = by_id(stages.quality_rules(spark, docs, SF))
    verdict = {r.doc.doc_id: r for r in quality.quality_rules(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    for r in docs.collect():
        n, *_, repeated = brute_counts(r.text)
        base = n < 50 or 100 * repeated > 50 * n
        assert (r.doc_id in kept) == (not base and not verdict[r.doc_id].rules_failed)
        assert r.doc_id not in kept or kept[r.doc_id] == r


def test_near_duplicates(spark, docs):
    rows = docs.collect()
    prints = {r.doc_id: brute_print(r.text, 4) for r in rows}
    of = brute_components(set(prints.values()), 4)
    first = {}
    for i, p in sorted(prints.items()):
        first.setdefault(of[p], i)
    kept = by_id(stages.near_duplicates(spark, docs, SF))
    assert set(kept) == set(first.values())
    assert all(kept[r.doc_id] == r for r in rows if r.doc_id in kept)


def test_substrings(spark, docs):
    kept = by_id(stages.substring_duplicates(spark, docs, SF))
    for i, _, n_removed, text in brute_substrings([(r.doc_id, r.text) for r in docs.collect()], 13):
        assert " ".join(words(kept[i].text)) == text and kept[i].n_chars == len(kept[i].text)
    rows = by_id(docs)
    untouched = [i for i, *_, n, _ in brute_substrings([(r.doc_id, r.text) for r in rows.values()], 13) if not n]
    assert all(kept[i].text == (rows[i].text or "") for i in untouched)


def test_mixing(spark, docs):
    rows = docs.collect()
    expected = {i: taken for i, *_, taken in brute_mix([(r.doc_id, r.source, len(words(r.text))) for r in rows], mixing.Mix())}
    out = stages.mix_sources(spark, docs, SF)
    assert out.schema == docs.schema
    got = dict.fromkeys(expected, 0)
    for r in out.collect():
        got[r.doc_id] += len(words(r.text))
    assert got == expected


def test_packing(spark, docs):
    got = {}
    for r in stages.pack_sequences(spark, docs, SF).collect():
        got.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for r in docs.collect():
        assert [i for _, ids in sorted(got[r.doc_id]) for i in ids] == ids_of(r.text)


def test_run(spark):
    """The packed ids are those of the stages applied one after the other."""
    now = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [now.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, SF).collect(), now.schema)
        sizes.append(now.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] < sizes[4]
    expected = sorted(tuple(ids_of(r.text)) for r in now.collect())
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert sum(r.length for r in pieces) == sum(map(len, expected))
    assert len({(r.sequence_id, r.offset) for r in pieces}) == len(pieces)


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_tables_pass_every_stage(spark, make):
    now = make(spark)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, now, SF)
        assert out.columns == now.columns
        now = spark.createDataFrame(out.collect(), now.schema)
    assert stages.quality_rules(spark, make(spark), SF).columns == make(spark).columns
    assert (stages.pack_sequences(spark, now, SF).count() == 0) == (make is empty)
