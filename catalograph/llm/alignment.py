"""Align the tokens of two tokenizers by diagonal run skipping.

Every text is encoded whole by both tokenizers; the running sums of their tokens' byte lengths say
where tokens end. Byte offsets where tokens of both end cut a text into groups, the smallest
stretches that both tokenizers cover with whole tokens. The two arrays of ends are walked along a diagonal, the
current shift between their indexes:

1. Exponential probing compares stretches of both arrays at this shift, each twice as long as the one
   before, until one differs; halving finds where. All tokens passed are groups of one to one.
2. The irregular group met is resolved by itself: the array that is behind moves on until both ends are
   equal again. The number of tokens on both sides updates the shift.

All pairs of one token of each side in a group are links. How many documents hold a pair of ids
linked is counted over the corpus: a task writes blocks of documents with the distinct pairs of the block,
only these with their numbers of documents are shuffled and summed up, and every block gets back the sums
of its own pairs. What a block holds is bounded by ``SLICE`` characters (or one document, if that is longer).

Ends are equal only if both tokenizers give back the text itself, byte by byte; this is checked.

Defined cases: a null or empty text, and one whose tokens do not give back its bytes, has no tokens: all
numbers are 0 and ``groups`` and ``groups_sha256`` are empty; a very long text is a block of its own; repeated rows
are documents each, also in the counts; an empty table gives an empty result; other columns travel in
the struct ``doc``.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.llm.common import tidy, written

SLICE = 2 << 20  # characters of a block
_FIRST = 32  # bit from which on a pair's number holds the first side's id
SPACE = "▁"  # stands for a space in pieces

# Texts of Latin, Greek and Cyrillic letters, ASCII and general punctuation: the compiled form of the
# byte-level tokenizer splits them alike. Others are left to the tokenizer's own splitting.
_USUAL = re.compile("[\t\n\r -~\xa1-\xac\xae-ɏΑ-ΡΣ-ώА-я‐-‧€]*")



def _byte_of_letter() -> dict[str, int]:
    """The byte for each letter of a byte-level vocabulary: printable bytes stand for themselves,
    the others for the letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE: ids of texts and the bytes of each id."""

    def __init__(self, path: str, ranks_path: str | None = None, pattern: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        letters = _byte_of_letter()
        self.bytes_of = [b""] * self.whole.get_vocab_size()
        for token, i in self.whole.get_vocab(with_added_tokens=False).items():
            self.bytes_of[i] = bytes(map(letters.__getitem__, token)) if all(c in letters for c in token) else token.encode()
        self.length_of = np.array([len(x) for x in self.bytes_of], np.int64)
        self.fast = None
        if ranks_path is not None:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            if all(self.bytes_of[i] == token for token, i in ranks.items()):  # the same vocabulary
                self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text behind a space; None where they do not give back its bytes."""
        out = []
        for text in texts:
            text = " " + text
            if self.fast is not None and _USUAL.fullmatch(text):
                ids = np.array(self.fast.encode_ordinary(text), np.int64)
                fine = int(self.length_of[ids].sum()) == len(text.encode())  # its ids are stretches of the text
            else:
                found = self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids
                ids = np.array(found, np.int64)
                fine = b"".join(map(self.bytes_of.__getitem__, found)) == text.encode()
            out.append(ids if fine else None)
        return out


class Pieces:
    """A sentence-piece model that puts a space before each text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [(i, self.model.id_to_piece(i)) for i in range(self.model.get_piece_size())]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in pieces]
        self.length_of = np.array([len(x) for x in self.bytes_of], np.int64)

    def __call__(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text; None where they do not give back its bytes behind a space."""
        out = []
        for text, ids in zip(texts, self.model.encode(texts, num_threads=1)):
            fine = b"".join(map(self.bytes_of.__getitem__, ids)) == b" " + text.encode()
            out.append(np.array(ids, np.int64) if fine else None)
        return out


def public_byte_level() -> ByteLevel:
    import public_tokenizers as public

    return ByteLevel(public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def public_pieces() -> Pieces:
    import public_tokenizers as public

    return Pieces(public.path("piece_bpe_32k.model"))


def walk(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """Runs and irregular groups of two rising arrays with the same last element: ``(i, j, n, x, y)`` is
    ``n`` groups of one to one from ``a[i]`` and ``b[j]`` on, then one of ``a[i + n : x]`` and
    ``b[j + n : y]`` (empty at the end)."""
    raw_a, raw_b = a.astype("<u8").tobytes(), b.astype("<u8").tobytes()  # eight bytes an element
    a, b = a.tolist(), b.tolist()
    i = j = 0
    end = len(a)
    number = int.from_bytes
    while i < end:
        first, second = i, j
        at, to = 8 * i, 8 * j
        step = 32
        left, right = raw_a[at : at + step], raw_b[to : to + step]
        while left == right and left:
            at += step
            to += step
            step += step
            left, right = raw_a[at : at + step], raw_b[to : to + step]
        if not left:  # equal to the end
            yield first, second, end - first, end, second + end - first
            return
        # The lowest bit that differs says which element does.
        differ = number(left, "little") ^ number(right, "little")
        n = (at >> 3) + ((differ & -differ).bit_length() - 1 >> 6) - first
        i += n
        j += n
        left, right = a[i], b[j]
        while left != right:
            if left < right:
                i += 1
                left = a[i]
            else:
                j += 1
                right = b[j]
        i += 1
        j += 1
        yield first, second, n, i, j


def _shown(a: list[str], b: list[str], runs: list[tuple[int, int, int, int, int]]) -> str:
    """The groups as text: ids of a side parted by commas, sides by bars, groups by semicolons. ``a`` and
    ``b`` are the ids' texts with a bar, or a semicolon, behind each."""
    out: list[str] = []
    for i, j, n, x, y in runs:
        pairs = [""] * (2 * n)
        pairs[::2] = a[i : i + n]
        pairs[1::2] = b[j : j + n]
        out += pairs
        if i + n < x:
            out.append("".join(a[i + n : x])[:-1].replace("|", ",") + "|" + "".join(b[j + n : y])[:-1].replace(";", ",") + ";")
    return "".join(out)[:-1]


class Aligner:
    """Aligns slices of texts; one per worker process."""

    def __init__(self, first: Callable[[], object], second: Callable[[], object]):
        self.sides = first(), second()
        self.length_of = [side.length_of for side in self.sides]
        self.name_of = [[f"{i}{mark}" for i in range(len(side.bytes_of))] for side, mark in zip(self.sides, "|;")]
        self.shift = max(len(self.sides[1].bytes_of) - 1, 1).bit_length()
        self.width = self.shift + max(len(self.sides[0].bytes_of) - 1, 1).bit_length()

    def __call__(self, texts: list[str], keep_text: bool) -> tuple[dict[str, list], dict[str, np.ndarray]]:
        """Numbers per text, and the links of all: per text its distinct pairs with how often they
        are linked; the distinct pairs of the slice with the texts that hold them."""
        numbers = {name: [] for name in ("n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256")}
        # Links as arrays over the slice: stretches of one to one, and the groups of others.
        a_all, b_all, runs, groups, doc_of_run, doc_of_group = [], [], [], [], [], []
        a_at = b_at = 0
        a_name, b_name = (x.__getitem__ for x in self.name_of)
        for doc, (text, a, b) in enumerate(zip(texts, *(side(texts) for side in self.sides))):
            if not text or a is None or b is None:
                for name, nothing in (("n_a", 0), ("n_b", 0), ("n_groups", 0), ("n_links", 0), ("groups", ""), ("groups_sha256", "")):
                    numbers[name].append(nothing)
                continue
            found = list(walk(*(np.cumsum(length[x]) for length, x in zip(self.length_of, (a, b)))))
            text = _shown(list(map(a_name, a.tolist())), list(map(b_name, b.tolist())), found)
            a_all.append(a)
            b_all.append(b)
            one = np.array(found, np.int64)
            i, j, n, x, y = one.T
            odd = np.flatnonzero(i + n < x)
            sizes = (x - i - n) * (y - j - n)
            numbers["n_a"].append(len(a))
            numbers["n_b"].append(len(b))
            numbers["n_groups"].append(int(n.sum()) + len(odd))
            numbers["n_links"].append(int(n.sum() + sizes.sum()))
            numbers["groups"].append(text if keep_text else None)
            numbers["groups_sha256"].append(hashlib.sha256(text.encode()).hexdigest())
            runs.append(np.stack([i + a_at, j + b_at, n]))
            groups.append(np.stack([(i + n)[odd] + a_at, (x - i - n)[odd], (j + n)[odd] + b_at, (y - j - n)[odd]]))
            doc_of_run.append(np.full(len(n), doc))
            doc_of_group.append(np.full(len(odd), doc))
            a_at += len(a)
            b_at += len(b)
        none = np.zeros(0, np.int64)
        if not runs:
            return numbers, {"pairs": none, "n_docs": none, "doc": none, "place": none, "times": none}
        a_ids, b_ids = np.concatenate(a_all), np.concatenate(b_all)
        i, j, n = np.concatenate(runs, axis=1)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        straight = a_ids[np.repeat(i, n) + within] << self.shift | b_ids[np.repeat(j, n) + within]
        straight |= np.repeat(np.concatenate(doc_of_run), n) << self.width
        i, n, j, m = np.concatenate(groups, axis=1)
        each = n * m
        within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        across = np.repeat(m, each)
        crossed = a_ids[np.repeat(i, each) + within // across] << self.shift | b_ids[np.repeat(j, each) + within % across]
        crossed |= np.repeat(np.concatenate(doc_of_group), each) << self.width
        held, times = np.unique(np.concatenate([straight, crossed]), return_counts=True)
        pairs, place, n_docs = np.unique(held & ((1 << self.width) - 1), return_inverse=True, return_counts=True)
        pairs = pairs >> self.shift << _FIRST | pairs & ((1 << self.shift) - 1)
        return numbers, {"pairs": pairs, "n_docs": n_docs, "doc": held >> self.width, "place": place, "times": times}


_aligners: dict[tuple, Aligner] = {}


def _slices(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, k
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _blocks(first: Callable[[], object], second: Callable[[], object], keep_text: bool):
    """A row per block: its documents and their numbers as arrays, its links as numbers in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (first.__qualname__, second.__qualname__)
        if key not in _aligners:
            _aligners[key] = Aligner(first, second)
        align = _aligners[key]
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, own = batch.column(1).to_pylist(), batch.column(0)
            for a, b in _slices(texts, SLICE):
                numbers, links = align(texts[a:b], keep_text)
                whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                columns = [
                    pa.array([block], pa.int64()),
                    whole(pa.concat_arrays([own.slice(a, b - a), own.slice(0, 0)])),
                    *[whole(pa.array(numbers[n], pa.int64())) for n in _NUMBERS],
                    *[whole(pa.array(numbers[n], pa.string())) for n in ("groups", "groups_sha256")],
                    whole(pa.array(links["pairs"], pa.int64())),
                    whole(pa.array(links["n_docs"], pa.int64())),
                    # Documents of the links as the number of links of each.
                    pa.array([np.bincount(links["doc"], minlength=b - a).astype("<u4").tobytes()], pa.binary()),
                    pa.array([links["place"].astype("<u4").tobytes()], pa.binary()),
                    pa.array([links["times"].astype("<u4").tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "docs", *_NUMBERS, "groups", "groups_sha256", "pairs", "n_docs", "held", "place", "times"])
                block += 1

    return run


def _summed(blocks: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a block with the sums over their links, from the counts of the block's pairs."""
    row = {name: blocks.column(name).combine_chunks() for name in blocks.column_names}
    held, place, times = (np.frombuffer(row[n][0].as_py(), "<u4").astype(np.int64) for n in ("held", "place", "times"))
    order = answers.column("place").to_numpy()
    value = np.zeros((2, len(order)), np.int64)
    value[0, order] = answers.column("best").to_numpy()
    value[1, order] = answers.column("n").to_numpy()
    sums = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum(value[:, place] * times, axis=1)], axis=1)
    ends = np.cumsum(held)
    names = ["doc", *_NUMBERS, "groups", "groups_sha256", "n_best", "count_sum"]
    columns = [row["docs"].flatten(), *[row[n].flatten() for n in names[1:7]]]
    return pa.Table.from_arrays([*columns, *[pa.array(s[ends] - s[ends - held], pa.int64()) for s in sums]], names=names)


def aligned(docs: DataFrame, text: str = "text", first: Callable[[], object] = public_byte_level, second: Callable[[], object] = public_pieces, carry: list[str] | None = None, keep_groups: bool = True) -> DataFrame:
    """``doc``, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links whose pair is in as many documents as
    any pair of the same first id), ``count_sum`` (documents of the pair, summed over links), ``groups`` and
    ``groups_sha256``.

    ``groups`` is the alignment as text (``a1,a2|b1;a3|b2,b3``), or null without ``keep_groups``; it is several
    times as long as the text. ``first`` and ``second`` make the tokenizers; they are called by the tasks.
    """
    kept = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    fields = [T.StructField("doc", rows.schema["doc"].dataType), *[T.StructField(n, T.LongType()) for n in _NUMBERS]]
    fields += [T.StructField(n, T.StringType()) for n in ("groups", "groups_sha256")]
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            *[T.StructField("docs" if f.name == "doc" else f.name, T.ArrayType(f.dataType)) for f in fields],
            *[T.StructField(n, T.ArrayType(T.LongType())) for n in ("pairs", "n_docs")],
            *[T.StructField(n, T.BinaryType()) for n in ("held", "place", "times")],
        ]
    )
    blocks = written(rows.mapInArrow(tidy(_blocks(first, second, keep_groups)), schema), "aligned-blocks")
    each = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "n_docs")).alias("place", "met"))
    each = each.select("block", "place", F.col("met.pairs").alias("pair"), F.col("met.n_docs").alias("n"))
    totals = each.groupBy("pair").agg(F.sum("n").alias("n"))
    totals = written(totals.withColumn("a", F.shiftright("pair", _FIRST)), "aligned-totals")
    most = totals.groupBy("a").agg(F.max("n").alias("most"))
    judged = totals.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))
    answers = each.drop("n").join(judged, "pair").select(F.col("block").alias("of"), "place", "n", "best")
    told = blocks.drop("pairs", "n_docs")
    out = T.StructType([*fields, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return told.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_summed, out)
