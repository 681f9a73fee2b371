"""Packing: exact round trip against encoding whole texts; windows within capacity."""

import random
import time

import numpy as np
import pytest
from awkward import awkward, awkward_rows, empty
from tokenizers import Tokenizer

from catalograph.llm import packing

WHOLE = Tokenizer.from_file(packing.word_bpe())


def ids_of(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 2]


def check(df, capacity=4096):
    texts = dict(enumerate(r.text for r in df.collect()))
    numbered = df.sparkSession.createDataFrame([*texts.items()], "row int, text string").repartition(df.rdd.getNumPartitions())
    windows, docs = {}, {}
    for r in packing.pack(numbered, packing.word_bpe, 2, capacity=capacity).collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length <= capacity
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        docs.setdefault((r.doc.row, r.doc_tokens), []).append((r.start, ids))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    got = {}
    for (row, total), pieces in docs.items():
        assert [start for start, _ in sorted(pieces)] == list(range(0, total, capacity))
        got[row] = [i for _, ids in sorted(pieces) for i in ids]
        assert len(got[row]) == total
    assert got == {row: ids_of(text) for row, text in texts.items()}
    return windows


def filled(windows, capacity=4096):
    return sum(n for pieces in windows.values() for _, n in pieces) / (capacity * len(windows))


def test_documents(spark):
    windows = check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1))
    assert filled(windows) > 0.95


@pytest.mark.parametrize("parts", [1, 64, 1000])
def test_padding_does_not_depend_on_partitions(spark, parts):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(parts)
    windows = {}
    for r in packing.pack(docs, packing.word_bpe, 2).select("sequence_id", "offset", "length").collect():
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in pieces) <= 4096 for pieces in windows.values())
    assert filled(windows) >= 0.97


@pytest.mark.parametrize("capacity", [1, 5, 64])
def test_awkward(spark, capacity):
    check(awkward(spark), capacity)


def test_piece_by_piece_encoding_is_exact():
    texts = [r[1] or "" for r in awkward_rows()]
    texts += ["a\x1cb\x85c\u2028d", "x<|endoftext|>y <|startoftext|>", "É é ΣΑΣ\tq\r\nk", "it's 'll we'RE 12a", "  ", "e \u0301x", "İI"]
    texts += [" ".join(random.Random(1).choices(texts, k=50))]
    for text, got in zip(texts, packing.PieceEncoder(packing.word_bpe())(texts)):
        assert np.frombuffer(got, "<u4").tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_every_character_that_is_split_here():
    """Alone, between letters and among others: each character whose small letters are taken for usual."""
    admitted = [chr(c) for c in range(0x3000) if packing._usual(chr(c).lower())]
    assert len(admitted) > 500 and "\u0181" not in admitted
    rng = random.Random(4)
    texts = [a + c + b for c in map(chr, range(1, 0x3000)) if packing._usual(c) or packing._usual(c.lower()) for a, b in (("", ""), ("a", "b"), ("1", "2"), ("!", "'s"), (" ", " "))]
    texts += ["".join(rng.choices(admitted, k=rng.randint(2, 30))) for _ in range(5000)]
    whole = [e.ids for e in WHOLE.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.PieceEncoder(packing.word_bpe())(texts)] == whole


def test_forgetting_known_pieces(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 10)
    encode = packing.PieceEncoder(packing.word_bpe())
    for text in ("a b c d e f g h", "i j k l m n a b", "a " * 50, " ".join(map(str, range(100)))):
        assert np.frombuffer(encode([text])[0], "<u4").tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_an_idle_worker_forgets(monkeypatch):
    monkeypatch.setattr(packing, "IDLE", 0.2)
    encode = packing.PieceEncoder(packing.word_bpe())
    encode.start()
    first = encode(["a b c"])
    encode.rest()
    encode.start()  # the next task comes in time
    time.sleep(0.4)
    assert encode.known
    encode.rest()
    time.sleep(0.6)
    assert not encode.known and encode(["a b c"]) == first


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(5)
    for capacity in (1, 7, 64, 4096):
        lengths = [rng.randint(1, capacity) for _ in range(300)]
        room, expected = [], {}
        for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
            fits = [r for r in room if r >= lengths[k]]
            tightest = min(fits, default=capacity)
            expected[k] = capacity - tightest
            if fits:
                room.remove(tightest)
            room.append(tightest - lengths[k])
        windows, offsets = packing.best_fit(lengths, capacity)
        assert offsets == [expected[k] for k in range(len(lengths))]
        assert len(set(windows)) == len(room)


def test_groups_and_empty(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 400)
    monkeypatch.setattr(packing, "SLICE", 100)
    check(awkward(spark).repartition(3), 64)
    assert packing.pack(empty(spark), packing.word_bpe, 2).count() == 0
    assert packing.pack(awkward(spark), packing.word_bpe, 2).schema["doc"].dataType.names == [c for c in awkward(spark).columns if c != "text"]
