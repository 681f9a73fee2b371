"""Remove repeated passages with prefix-partitioned suffix trees.

Every word sequence of ``window`` words that already starts in a document with a
smaller id is a repeat, and the words it covers go. Sequences of that length are the
nodes at depth ``window`` of the tree of all word suffixes, so the tree is cut there.

Suffixes are written over a small alphabet: a word's letter is four bits of its hash, a
suffix's key is its first letters and, in the rest of 64 bits, a hash of the whole
window. Sorting keys sorts suffixes, and sorted neighbours with equal letters share a
path, so a sorted group of keys is a subtree. Groups are the suffixes under prefixes of
varying length: a count of all four-letter prefixes (65,536 numbers whatever the input)
tells where a shorter prefix is enough and where more letters are needed so that a group
fits ``GROUP`` suffixes.

Documents are first packed into batches of about 4 MB and written, bucketed by batch, so
that answers come back to them without moving the text again. Then

1. every batch sends its distinct keys to their subtrees, which answer with a bit for each
   key: does the path go on in another batch? Few suffixes are left after that;
2. for the rest, batches send two more hashes of the words (96 bits) and the smallest
   document id; the subtrees answer with a bit: is there a smaller one elsewhere?

Equal passages, however many, are one entry per batch and subtree, so hot passages cost
no more than rare ones. All three passes compute the same keys from the same stored batch.

Defined cases: a null or empty text has no words; texts shorter than the window lose
nothing; rows that repeat an id do not shorten each other; rows with a null id neither
lose nor claim a passage; an empty table gives an empty result; other columns travel in
the struct ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.llm.common import new_folder, partitions, tidy, written

WINDOW = 13
BATCH = 4 << 20  # bytes of text in a batch
GROUP = 1 << 20  # suffixes in a subtree
LETTER = 4  # bits of a letter
LETTERS = 13  # letters in a key; the other bits are a hash of the window
COUNTED = 4  # letters of the counted prefixes
# Odd multipliers of the two word hashes and their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
BLOCK = 1 << 20  # bytes hashed at once


@cache
def _powers(base: int) -> np.ndarray:
    """``base**i`` modulo 2**64 for the places of a block."""
    return _power(base, BLOCK)


def _power(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


@dataclass
class Suffixes:
    """Words and windows of a batch of texts; windows lie within one text with an id."""

    raw: bytes
    doc_at: np.ndarray  # first byte of each text
    starts: np.ndarray  # bytes at which words start and end
    ends: np.ndarray
    doc: np.ndarray  # a word's text
    at: np.ndarray  # the word at which a window starts
    key: np.ndarray  # a window's key
    hashes: tuple[np.ndarray, ...]  # its hashes


def _word_hashes(data: np.ndarray, space: np.ndarray, starts: np.ndarray, which: int) -> np.ndarray:
    """A polynomial hash of each word's bytes, the same wherever the word stands."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        at = int(starts[first])
        last = int(np.searchsorted(starts, at + BLOCK, side="right"))
        end = int(starts[last]) if last < len(starts) else len(data)
        if end - at > BLOCK and last > first + 1:  # the last word may reach beyond: it starts the next block
            last -= 1
            end = int(starts[last])
        n = end - at
        up, down = (_powers(b) if n <= BLOCK else _power(b, n) for b in (BASES[which], INVERSES[which]))
        values = data[at:end].astype(np.uint64) + np.uint64(1)
        values[space[at:end]] = 0
        values *= up[:n]
        places = starts[first:last] - at
        out[first:last] = np.add.reduceat(values, places) * down[places]
        first = last
    return _mixed(out)


def suffixes(texts: list[str | None], ids: list[int | None], window: int, n_hashes: int) -> Suffixes:
    encoded = [(t or "").encode() for t in texts]
    raw = b" ".join(encoded)
    data = np.frombuffer(raw, np.uint8)
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) + 1
    doc_at = np.cumsum(sizes) - sizes
    space = _SPACE[data]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    doc = np.searchsorted(doc_at, starts, side="right") - 1
    n = len(starts) - window + 1
    if n <= 0:
        none = np.zeros(0, np.uint64)
        return Suffixes(raw, doc_at, starts, ends, doc, np.zeros(0, np.int64), none, (none,) * n_hashes)
    named = np.array([i is not None for i in ids])
    whole = (doc[:n] == doc[window - 1 :]) & named[doc[:n]]
    at = np.flatnonzero(whole)
    hashes = []
    for which in range(n_hashes):
        words = _word_hashes(data, space, starts, which)
        if which == 0:
            key = np.zeros(n, np.uint64)
            for k in range(min(window, LETTERS)):
                key |= (words[k : k + n] >> np.uint64(64 - LETTER)) << np.uint64(64 - LETTER * (k + 1))
        total = np.zeros(n, np.uint64)
        for k in range(window):
            total = total * np.uint64(BASES[1 - which]) + words[k : k + n]
        hashes.append(_mixed(total)[at])
    rest = np.uint64(64 - LETTER * min(window, LETTERS))
    return Suffixes(raw, doc_at, starts, ends, doc, at, key[at] | (hashes[0] >> (np.uint64(64) - rest)), tuple(hashes))


# ---- batches --------------------------------------------------------------------


def _pack(text: str, doc_id: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.StructArray] = []
        size, number = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, number
            rows = pa.concat_arrays(held)
            found = suffixes(rows.field(text).to_pylist(), rows.field(doc_id).to_pylist(), window, 1)
            counts = np.bincount((_distinct(found.key) >> np.uint64(64 - LETTER * COUNTED)).astype(np.int64), minlength=1 << (LETTER * COUNTED))
            some = np.flatnonzero(counts)
            listed = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
            prefix, n = (pa.array([x.tolist()], pa.list_(pa.int32())) for x in (some, counts[some]))
            held, size, number = [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), listed, prefix, n], names=["number", "docs", "prefix", "n"])

        for batch in batches:
            rows = batch.column(0)
            lengths = pa.compute.fill_null(pa.compute.binary_length(rows.field(text)), 0).to_numpy(zero_copy_only=False)
            first = 0
            for k, length in enumerate(lengths.tolist()):
                if size and size + length > BATCH:
                    if k > first:
                        held.append(rows.slice(first, k - first))
                    if held:
                        yield flush()
                    first = k
                size += length + 1
            if first < len(rows):
                # A copy, so that the batch it was cut from can go.
                held.append(pa.concat_arrays([rows.slice(first), rows.slice(0, 0)]))
        if held:
            yield flush()

    return tidy(run)


def _packed(docs: DataFrame, text: str, doc_id: str, window: int) -> DataFrame:
    """Batches ``(batch, docs, prefix, n)`` as a stored table, bucketed by batch."""
    spark = docs.sparkSession
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    schema = T.StructType(
        [
            T.StructField("number", T.LongType()),
            T.StructField("docs", T.ArrayType(rows.schema["doc"].dataType)),
            T.StructField("prefix", T.ArrayType(T.IntegerType())),
            T.StructField("n", T.ArrayType(T.IntegerType())),
        ]
    )
    packed = rows.mapInArrow(_pack(text, doc_id, window), schema)
    packed = packed.withColumn("batch", F.monotonically_increasing_id()).drop("number")
    folder = new_folder(spark, "substring_batches")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    writer = packed.write.bucketBy(partitions(spark), "batch").format("parquet").option("compression", "zstd")
    writer.option("path", folder).saveAsTable(name)
    table = spark.table(name)
    # Buckets need a catalog entry to be written; the plan has what it needs, and the files stay.
    spark.sql(f"DROP TABLE {name}")
    return table


def prefix_lengths(counts: dict[int, int], limit: int) -> np.ndarray:
    """For every prefix of COUNTED letters, how many letters name its group: as few as keep the
    group within ``limit`` suffixes, or more than were counted where even those do not."""
    numbers = np.zeros(1 << (LETTER * COUNTED), np.int64)
    for prefix, n in counts.items():
        numbers[prefix] = n
    length = np.full(len(numbers), -1)
    for letters in range(COUNTED + 1):
        sums = numbers.reshape(1 << (LETTER * letters), -1).sum(axis=1)
        fits = np.repeat(sums <= limit, len(numbers) // len(sums))
        length[(length < 0) & fits] = letters
    deeper = COUNTED + np.ceil(np.log2(np.maximum(numbers, 1) / limit) / LETTER).astype(int)
    return np.where(length < 0, np.minimum(deeper, LETTERS), length).astype(np.uint8)


def _groups(keys: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The group of each key, as its prefix: it grows with the key."""
    bits = lengths[(keys >> np.uint64(64 - LETTER * COUNTED)).astype(np.int64)].astype(np.uint64) * np.uint64(LETTER)
    cut = np.uint64(64) - bits
    prefix = np.where(bits > 0, (keys >> np.minimum(cut, np.uint64(63))) << np.minimum(cut, np.uint64(63)), np.uint64(0))
    return (prefix >> np.uint64(1)).astype(np.int64)


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values. By sorting: several times as fast as the hash table of ``np.unique``."""
    values = np.sort(values)
    return values[np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]])]


def _cuts(values: np.ndarray) -> np.ndarray:
    """Places at which a run of equal values starts, and the end."""
    return np.concatenate([[0], np.flatnonzero(np.diff(values)) + 1, [len(values)]])


# ---- what batches send and subtrees answer --------------------------------------


def _squeezed(keys: np.ndarray) -> bytes:
    """Sorted keys as steps of as many bytes as the largest needs."""
    steps = np.diff(keys, prepend=np.uint64(0))
    first, rest = steps[:1], steps[1:]
    width = max(1, (int(rest.max()).bit_length() + 7) // 8) if len(rest) else 1
    body = rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + first.astype("<u8").tobytes() + body.tobytes()


def _expanded(blob: bytes) -> np.ndarray:
    width = blob[0]
    first = np.frombuffer(blob, "<u8", 1, 1)
    body = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    rest = np.zeros((len(body), 8), np.uint8)
    rest[:, :width] = body
    return np.cumsum(np.concatenate([first, rest.reshape(-1).view("<u8")]), dtype=np.uint64)


def _flags(answers: list[dict] | None, n: int) -> np.ndarray:
    """The bits that the groups answered, in the order of the keys."""
    if not answers:
        return np.zeros(n, bool)
    answers = sorted(answers, key=lambda a: a["grp"])
    return np.concatenate([np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=a["n"]) for a in answers]).astype(bool)


@dataclass
class Candidates:
    """Windows left after the first round; ``first`` marks distinct ones among them, sorted by key."""

    window: np.ndarray  # places in Suffixes.at
    ids: np.ndarray
    entry: np.ndarray  # a window's distinct entry
    key: np.ndarray  # of the entries: key, two hashes, smallest id
    hash1: np.ndarray
    hash2: np.ndarray
    least: np.ndarray


def candidates(found: Suffixes, ids: list[int | None], answers: list[dict] | None) -> Candidates:
    """Windows whose key goes on in another batch or another document of this one."""
    doc_ids = np.array([0 if i is None else i for i in ids], np.int64)[found.doc[found.at]]
    order = np.argsort(found.key)
    cuts = _cuts(found.key[order])
    elsewhere = _flags(answers, len(cuts) - 1) if len(order) else np.zeros(0, bool)
    if len(order):
        low, high = (f.reduceat(doc_ids[order], cuts[:-1]) for f in (np.minimum, np.maximum))
        chosen = order[np.repeat(elsewhere | (low != high), np.diff(cuts))]
    else:
        chosen = order
    key, one, two, own = found.key[chosen], found.hashes[0][chosen], found.hashes[1][chosen] >> np.uint64(32), doc_ids[chosen]
    by = np.lexsort((own, two, one, key))
    chosen, key, one, two, own = (x[by] for x in (chosen, key, one, two, own))
    new = np.ones(len(key), bool)
    new[1:] = (np.diff(key) != 0) | (np.diff(one) != 0) | (np.diff(two) != 0)
    return Candidates(chosen, own, np.cumsum(new) - 1, key[new], one[new], two[new].astype("<u4"), own[new])


def _send_keys(text: str, doc_id: str, window: int, lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                docs = batch.column("docs")[row].values
                keys = _distinct(suffixes(docs.field(text).to_pylist(), docs.field(doc_id).to_pylist(), window, 1).key)
                if len(keys):
                    groups = _groups(keys, lengths)
                    cuts = _cuts(groups)
                    blobs = [_squeezed(keys[a:b]) for a, b in zip(cuts, cuts[1:])]
                    number = np.full(len(blobs), batch.column("batch")[row].as_py())
                    yield pa.RecordBatch.from_arrays([pa.array(groups[cuts[:-1]]), pa.array(number), pa.array(blobs, pa.binary())], names=["grp", "batch", "blob"])

    return tidy(run)


def _send_candidates(text: str, doc_id: str, window: int, lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                docs = batch.column("docs")[row].values
                ids = docs.field(doc_id).to_pylist()
                found = suffixes(docs.field(text).to_pylist(), ids, window, 2)
                left = candidates(found, ids, batch.column("answers")[row].as_py())
                if len(left.key):
                    groups = _groups(left.key, lengths)
                    cuts = _cuts(groups)
                    blobs = [left.hash1[a:b].astype("<u8").tobytes() + left.least[a:b].astype("<i8").tobytes() + left.hash2[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                    number = np.full(len(blobs), batch.column("batch")[row].as_py())
                    yield pa.RecordBatch.from_arrays([pa.array(groups[cuts[:-1]]), pa.array(number), pa.array(blobs, pa.binary())], names=["grp", "batch", "blob"])

    return tidy(run)


def _shared_paths(blobs: list[bytes]) -> list[np.ndarray]:
    """For each batch's keys of one subtree: does another batch have the same path?"""
    keys = [_expanded(b) for b in blobs]
    every = np.concatenate(keys)
    order = np.argsort(every)
    cuts = _cuts(every[order])
    shared = np.empty(len(every), bool)
    shared[order] = np.repeat(np.diff(cuts) > 1, np.diff(cuts))
    return np.split(shared, np.cumsum([len(k) for k in keys])[:-1])


def _claimed(blobs: list[bytes]) -> list[np.ndarray]:
    """For each batch's passages of one subtree: does another batch have it under a smaller id?"""
    sizes = [len(b) // 20 for b in blobs]
    one = np.concatenate([np.frombuffer(b, "<u8", n) for b, n in zip(blobs, sizes)])
    least = np.concatenate([np.frombuffer(b, "<i8", n, 8 * n) for b, n in zip(blobs, sizes)])
    two = np.concatenate([np.frombuffer(b, "<u4", n, 16 * n) for b, n in zip(blobs, sizes)])
    order = np.lexsort((least, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order].astype(np.int64)) != 0)
    owner = least[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    claimed = np.empty(len(order), bool)
    claimed[order] = owner < least[order]
    return np.split(claimed, np.cumsum(sizes)[:-1])


def _answers(sent: DataFrame, judge) -> DataFrame:
    """One row per batch with the bits that its groups answered."""

    def close(batch: list[int], blobs: list[bytes], group: int) -> pa.RecordBatch:
        bits = judge(blobs)
        columns = [pa.array(batch, pa.int64()), pa.array([group] * len(batch), pa.int64()), pa.array([len(b) for b in bits], pa.int32()), pa.array([np.packbits(b).tobytes() for b in bits], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["batch", "grp", "n", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, numbers, blobs = None, [], []
        for batch in batches:
            for g, b, blob in zip(batch.column("grp").to_pylist(), batch.column("batch").to_pylist(), batch.column("blob").to_pylist()):
                if g != group and blobs:
                    yield close(numbers, blobs, group)
                    numbers, blobs = [], []
                group = g
                numbers.append(b)
                blobs.append(blob)
        if blobs:
            yield close(numbers, blobs, group)

    dealt = sent.repartition(partitions(sent.sparkSession), "grp").sortWithinPartitions("grp", "batch")
    bits = dealt.mapInArrow(tidy(run), "batch long, grp long, n int, bits binary")
    return bits.groupBy("batch").agg(F.collect_list(F.struct("grp", "n", "bits")).alias("answers"))


# ---- the operator ---------------------------------------------------------------


def _cut_out(text: str, doc_id: str, window: int, spacing: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                docs = batch.column("docs")[row].values
                ids = docs.field(doc_id).to_pylist()
                found = suffixes(docs.field(text).to_pylist(), ids, window, 2)
                left = candidates(found, ids, batch.column("answers")[row].as_py())
                claimed = _flags(batch.column("owners")[row].as_py(), len(left.key))
                gone = (claimed[left.entry] | (left.ids > left.least[left.entry])) if len(left.key) else np.zeros(0, bool)
                yield _rest(docs, found, found.at[left.window[gone]], window, spacing)

    return tidy(run)


def _rest(docs: pa.StructArray, found: Suffixes, gone: np.ndarray, window: int, spacing: bool) -> pa.RecordBatch:
    """The result rows of a batch, given the words at which removed windows start."""
    depth = np.zeros(len(found.starts) + 1, np.int64)
    np.add.at(depth, gone, 1)
    np.add.at(depth, gone + window, -1)
    covered = np.cumsum(depth[:-1]) > 0
    first = np.searchsorted(found.doc, np.arange(len(docs) + 1))
    n_words = np.diff(first)
    total = np.concatenate([[0], np.cumsum(covered)])
    n_removed = total[first[1:]] - total[first[:-1]]
    sizes = np.append(found.doc_at[1:], len(found.raw) + 1) - 1
    texts, spans = [], []
    for k in range(len(docs)):
        a, b = int(first[k]), int(first[k + 1])
        whole = found.raw[found.doc_at[k] : sizes[k]]
        if not n_removed[k]:
            texts.append(whole if spacing else b" ".join(whole.split()))
            spans.append([])
            continue
        edge = np.diff(np.concatenate([[False], covered[a:b], [False]]).astype(np.int8))
        on, off = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        spans.append([{"start": int(x), "end": int(y)} for x, y in zip(on, off)])
        pieces, place = [], int(found.doc_at[k])
        for x, y in zip(on, off):
            pieces.append(found.raw[place : found.starts[a + x]])
            place = int(found.starts[a + y]) if a + y < b else int(sizes[k])
        pieces.append(found.raw[place : sizes[k]])
        rest = b"".join(pieces)
        texts.append(rest if spacing else b" ".join(rest.split()))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    columns = [docs, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, kind), pa.array([t.decode() for t in texts], pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["doc", "n_words", "n_removed", "spans", "kept_text"])


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, spacing: bool = True) -> DataFrame:
    """``doc`` (struct of all columns), ``n_words``, ``n_removed``, ``spans`` (word ranges removed)
    and ``kept_text`` of every row: the text without them, with its white space, or without
    ``spacing`` its words joined by one space. ``doc_id`` is an integer column."""
    packed = _packed(docs, text, doc_id, window)
    counted = packed.select(F.explode(F.arrays_zip("prefix", "n")).alias("x")).groupBy("x.prefix").agg(F.sum("x.n").alias("n"))
    lengths = prefix_lengths({r["prefix"]: r["n"] for r in counted.collect()}, GROUP)  # 65,536 rows at most

    sent = packed.select("batch", "docs").mapInArrow(_send_keys(text, doc_id, window, lengths), "grp long, batch long, blob binary")
    answers = written(_answers(sent, _shared_paths), "substring-paths")
    batches = packed.select("batch", "docs").join(answers.hint("shuffle_hash"), "batch", "left")
    sent = batches.mapInArrow(_send_candidates(text, doc_id, window, lengths), "grp long, batch long, blob binary")
    owners = written(_answers(sent, _claimed).withColumnRenamed("answers", "owners"), "substring-owners")
    batches = batches.join(owners.hint("shuffle_hash"), "batch", "left")
    doc = packed.schema["docs"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("doc", doc),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
            T.StructField("kept_text", T.StringType()),
        ]
    )
    return batches.mapInArrow(_cut_out(text, doc_id, window, spacing), schema)
