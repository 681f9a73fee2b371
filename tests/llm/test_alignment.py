"""Alignment against brute force over common ends, from encodings of whole texts."""

import base64
import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pytest
import sentencepiece
from awkward import awkward, awkward_rows, empty
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from catalograph.llm import alignment, queries

WHOLE = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
WHOLE.encode_special_tokens = True
MODEL = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
# The compiled vocabulary says the bytes of the first side's ids in another way than the operator reads them.
BYTES = {int(b): base64.b64decode(a) for a, b in (line.split() for line in open(public.path("byte_bpe_50k.tiktoken"), "rb"))}
NOTHING = (0, 0, 0, 0, 0, 0, "")


def piece(i):
    return bytes([int(MODEL.id_to_piece(i)[3:5], 16)]) if MODEL.is_byte(i) else MODEL.id_to_piece(i).replace("▁", " ").encode()


def groups_of(text):
    if not text:
        return None
    a, b = WHOLE.encode(" " + text, add_special_tokens=False).ids, MODEL.encode(text)
    sides = [[(i, BYTES[i]) for i in a], [(i, piece(i)) for i in b]]
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in sides):
        return None
    ends = []
    for side in sides:
        at, own = 0, []
        for i, x in side:
            at += len(x)
            own.append((at, i))
        ends.append(own)
    common = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
    groups = [([], []) for _ in common]
    for k, side in enumerate(ends):
        for e, i in side:
            groups[bisect_left(common, e)][k].append(i)
    return groups


def brute(texts):
    """A row of numbers per text, in order."""
    groups = [groups_of(t) for t in texts]
    links = [[(a, b) for left, right in g or () for a in left for b in right] for g in groups]
    count = Counter(p for own in links for p in set(own))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for g, own in zip(groups, links):
        if g is None:
            out.append(NOTHING)
            continue
        shown = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in g)
        best = sum(count[p] == most[p[0]] for p in own)
        out.append((sum(len(x) for x, _ in g), sum(len(x) for _, x in g), len(g), len(own), best, sum(count[p] for p in own), hashlib.sha256(shown.encode()).hexdigest()))
    return out


def result(df):
    return [tuple(r) for r in df.select("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]


def test_whole_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    expected = {d.doc_id: r for d, r in zip(docs, brute([d.text for d in docs]))}
    got = queries.op12_cross_tokenizer_alignment(spark, sf)
    assert [c for c, _ in got.dtypes] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == expected


@pytest.mark.parametrize("most", [1, 200, 1 << 20])
def test_awkward(spark, monkeypatch, most):
    monkeypatch.setattr(alignment, "SLICE", most)
    rows = awkward_rows()
    for docs in (awkward(spark).coalesce(1), awkward(spark).repartition(3)):
        out = alignment.aligned(docs)
        assert sorted(result(out)) == sorted(brute([r[1] for r in rows]))
        assert out.schema["doc"].dataType.names == docs.columns
        for r in out.collect():
            assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")
    bare = alignment.aligned(awkward(spark), keep_groups=False, carry=["doc_id"])
    assert [r.groups for r in bare.where("n_a > 0").collect()] == [None] * sum(r[0] > 0 for r in brute([r[1] for r in rows]))


def test_empty(spark):
    assert alignment.aligned(empty(spark)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string")
    assert result(alignment.aligned(nothing)) == [NOTHING] * 2


def odd_texts(n):
    rng = random.Random(3)
    chars = [chr(c) for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000] + list("▁ \n\t  aeiou'sltREVE<|>0123") * 40
    texts = ["".join(rng.choices(chars, k=rng.randint(1, 40))) for _ in range(n)]
    return [*texts, "a▁b", " lead", "trail ", "  ", "\x00", "a\x00b", "<|endoftext|>", "</s><unk>", "　x", "ﬁ", "é", "🎉🎉", "﻿x", "a\r\nb", " ".join(texts)]


def test_odd_texts(spark):
    texts = odd_texts(300)
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id int, text string")
    got = {r.doc.doc_id: r for r in alignment.aligned(docs).collect()}
    for k, expected in enumerate(brute(texts)):
        r = got[k]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == expected, repr(texts[k])


def test_compiled_splitting_is_the_tokenizers_own():
    """Every character that is left to the compiled form, beside others of all kinds."""
    side = alignment.public_byte_level()
    assert side.fast is not None
    admitted = [chr(c) for c in range(0x3000) if alignment._USUAL.fullmatch(chr(c))]
    rng = random.Random(7)
    texts = [a + c + b for c in admitted for a, b in (("", ""), ("a", "b"), (" ", " "), ("1", "'s"), ("!", " x"))]
    texts += ["".join(rng.choices(admitted, k=rng.randint(2, 30))) for _ in range(5000)]
    assert [x.tolist() for x in side(texts)] == [WHOLE.encode(" " + t, add_special_tokens=False).ids for t in texts]


def rising(rng, n, end):
    return sorted(rng.sample(range(1, end), n)) + [end]


@pytest.mark.parametrize("share", [0.0, 0.5, 0.9, 0.99])
def test_walk(share):
    rng = random.Random(int(100 * share))
    for _ in range(300):
        end = rng.randint(2, 400)
        a = rising(rng, rng.randint(0, end - 1), end)
        b = sorted({x for x in a if rng.random() < share} | {x for x in rising(rng, rng.randint(0, end - 1), end) if rng.random() > share} | {end})
        cuts = []
        i = j = 0
        for first, second, n, x, y in alignment.walk(np.array(a), np.array(b)):
            assert (first, second) == (i, j)
            assert a[i : i + n] == b[j : j + n]
            cuts += a[i : i + n]
            if i + n < x:
                cuts.append(a[x - 1])
                assert a[x - 1] == b[y - 1]
            i, j = x, y
        assert (i, j) == (len(a), len(b))
        assert cuts == sorted(set(a) & set(b))
