"""Token counts against a byte-by-byte count."""

import random

import numpy as np
from awkward import awkward, awkward_rows, empty
from pyspark.sql import functions as F

from catalograph.llm import tokens


def encoding():
    return tokens._encoding(*tokens.byte_bpe())[0]


def brute(text, sections):
    """Tokens by section: the one with most of a token's bytes, the first among equals; -1 for none."""
    owner = [-1] * len(text.encode())
    sized = [len(c.encode()) for c in text]
    at = np.concatenate([[0], np.cumsum(sized)]).astype(int)
    for k, (a, b) in enumerate(sections):
        for byte in range(at[a], at[b]):
            owner[byte] = k
    counts, place = {}, 0
    for token in encoding().encode_ordinary(text):
        size = len(encoding().decode_single_token_bytes(token))
        held = owner[place : place + size]
        best = max(dict.fromkeys(held), key=held.count)
        counts[best] = counts.get(best, 0) + 1
        place += size
    return counts


def lines(text):
    out, at = [], 0
    for line in text.split("\n"):
        end = min(at + len(line) + 1, len(text))
        if end > at:
            out.append((at, end))
        at = end
    return out


def test_lines_of_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = {}
    for r in tokens.token_counts(df).collect():
        got.setdefault(r.doc.doc_id, {})[r.section] = (r.start, r.end, r.n_tokens, r.doc_tokens)
    for doc_id, text in df.collect():
        if not text:
            assert doc_id not in got
            continue
        spans, counts = lines(text), brute(text, lines(text))
        assert [got[doc_id][k][:2] for k in range(len(spans))] == spans
        assert {k: v[2] for k, v in got[doc_id].items() if v[2]} == counts
        assert {v[3] for v in got[doc_id].values()} == {len(encoding().encode_ordinary(text))}


def test_given_sections(spark):
    rng = random.Random(4)
    rows = []
    for i in range(40):
        text = "".join(rng.choice(["the ", "Größe", "東京 ", "🎉", "a", " ", "\n", "word"]) for _ in range(30))
        cuts = sorted(rng.choices(range(len(text) + 1), k=2 * rng.randint(0, 4)))
        rows.append((i, text, list(zip(cuts[::2], cuts[1::2]))))
    df = spark.createDataFrame(rows, "doc_id int, text string, s array<struct<start:int,end:int>>")
    got = {}
    for r in tokens.token_counts(df, sections=F.col("s")).collect():
        got.setdefault(r.doc.doc_id, {})[r.section] = r.n_tokens
    for i, text, spans in rows:
        assert {k: n for k, n in got[i].items() if n} == brute(text, spans)


def test_awkward_and_empty(spark):
    out = tokens.token_counts(awkward(spark))
    assert out.schema["doc"].dataType.names == awkward(spark).columns
    assert out.agg(F.sum("n_tokens")).first()[0] == sum(len(encoding().encode_ordinary(r[1] or "")) for r in awkward_rows())
    assert tokens.token_counts(empty(spark)).count() == 0
    outside = tokens.token_counts(awkward(spark), sections=F.expr("array(named_struct('start', -5, 'end', 1000000))"))
    assert outside.where("section = -1").count() == 0
