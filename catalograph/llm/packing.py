"""Pack token sequences into windows by best-fit decreasing.

A document is encoded whole and ends with an end token. What exceeds the capacity is
first cut into full windows; the remainders are placed from the longest to the
shortest, each into the open window it fills best. A segment tree indexed by remaining
capacity finds that window: the smallest remainder that is large enough.

Packing is done twice. A task first packs its own documents in groups of ``GROUP`` token bytes, so memory is
bounded; windows with at most one ``CLOSED``-th of their room left are final. The pieces of the others
are few where a task has many documents, and all where it has a handful; only their keys and
lengths are shuffled, into groups whose number follows from the ids they hold, and packed again. So
padding does not depend on how the input is partitioned. Pieces are written between the two, so a
task that runs again changes no numbers.

The tokenizer first splits a text into words, digits and runs of other signs and encodes
each by itself. Texts in Latin letters are split here by the same pattern and the ids of
pieces are kept, as most pieces recur; other texts are encoded whole. The tests compare
both with encoding whole texts.

Defined cases: a null or empty text is the end token alone; a text that is longer than the
window fills windows of its own and leaves one remainder; repeated rows are packed each; an
empty table gives an empty result; other columns travel in the struct ``doc``.
"""

from __future__ import annotations

import os
import re
import threading
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.llm.common import tidy, trim, written

CAPACITY = 4096
GROUP = 12 << 20  # bytes of ids packed together
CLOSED = 64  # a window with at most this part of its room left is final
AGAIN = 1 << 62  # first number of the windows that are packed again
KNOWN = 500_000  # pieces whose ids a worker keeps at most
IDLE = 2.0  # seconds without a task after which a worker forgets them
SLICE = 4 << 20  # characters encoded at once


class OpenWindows:
    """Windows by remaining capacity, in a segment tree of counts."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(self.size)]

    def _add(self, room: int, n: int) -> None:
        at = self.size + room
        while at:
            self.count[at] += n
            at >>= 1

    def put(self, window: int, room: int) -> None:
        if room:
            self.windows[room].append(window)
            self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """The window with the smallest room of at least ``least``, and that room."""
        at = self.size + least
        if not self.count[at]:
            # Up until a right neighbour has windows, then down to its leftmost.
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.size
        self._add(room, -1)
        return self.windows[room].pop(), room


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Window and offset of each length, none above ``capacity``; windows count from 0."""
    windows, offsets = [0] * len(lengths), [0] * len(lengths)
    tree, n = OpenWindows(capacity), 0
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = tree.take(lengths[k])
        if found is None:
            found, n = (n, capacity), n + 1
        window, room = found
        windows[k], offsets[k] = window, capacity - room
        tree.put(window, room - lengths[k])
    return windows, offsets


# Texts of Latin letters, ASCII and general punctuation, without the mark of special tokens.
_UNUSUAL = re.compile("[^\t-\r -~\xa1-\u012f\u0131-\u024f\u2010-\u2027]|<\\|")
_LETTER, _NUMBER = (
    "".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == kind).replace("-", r"\-") for kind in "LN"
)
# Fixed value: the tokenizer's own splitting pattern, for these characters (letters before the
# contractions, which start otherwise).
_PIECE = re.compile(f"[{_LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+")


def _usual(text: str) -> bool:
    """Only characters that are split here as the tokenizer splits them?"""
    if "<|" not in text and text.replace("\n", " ").isprintable():
        try:
            text.encode("latin-1")
            return True
        except UnicodeEncodeError:
            pass
    return not _UNUSUAL.search(text)


class PieceEncoder:
    """Ids of texts as little-endian 32-bit numbers; of usual texts piece by piece."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        words = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for word, i in words.items() if word.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.again: set[str] = set()
        self.busy = threading.Lock()
        self.timer: threading.Timer | None = None

    def start(self) -> None:
        if self.timer is not None:
            self.timer.cancel()

    def rest(self) -> None:
        """Forget all pieces unless another task of this worker starts soon: others may need the memory."""
        self.timer = threading.Timer(IDLE, self.clear)
        self.timer.daemon = True
        self.timer.start()

    def clear(self) -> None:
        with self.busy:
            self.known, self.again = {}, set()
        trim()

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _forget(self) -> None:
        """Keep pieces that were met again since the last time, at most half of what fits: most are met once."""
        kept = islice(self.again.intersection(self.known), KNOWN // 2)
        self.known = {p: self.known[p] for p in kept}
        self.again.clear()

    def _learn(self, pieces: list[str]) -> None:
        for first in range(0, len(pieces), 5000):
            part = pieces[first : first + 5000]
            ids = self._ids(" ".join(part))
            stops = 4 * (np.flatnonzero(self.ends[ids]) + 1)  # a piece's last token says so
            if len(stops) != len(part):
                self.known.update((p, self._ids(p).tobytes()) for p in part)
                continue
            raw, stops = ids.tobytes(), stops.tolist()
            self.known.update(zip(part, (raw[a:b] for a, b in zip([0, *stops], stops))))

    def __call__(self, texts: list[str]) -> list[bytes]:
        with self.busy:
            return self._encoded(texts)

    def _encoded(self, texts: list[str]) -> list[bytes]:
        # Some letters that are split alike have small letters that are not.
        lower = [t.lower() for t in texts]
        pieces = [_PIECE.findall(t) if _usual(t) else None for t in lower]
        met = set(chain.from_iterable(filter(None, pieces)))
        if len(self.known) > KNOWN:
            self._forget()
        new = met.difference(self.known)
        self.again.update(met.difference(new))
        self._learn(list(new))
        look = self.known.__getitem__
        return [self._ids(t).tobytes() if p is None else b"".join(map(look, p)) for t, p in zip(texts, pieces)]


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The tokenizer of this worker process, loaded once."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def slices(texts: list[str], most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters."""
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text) + 1
        if size >= most:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _packed(rows: list[tuple[pa.StructArray, list[bytes]]], capacity: int, first: int) -> tuple[pa.RecordBatch, int]:
    """The pieces of some documents with their windows, numbered from ``first``."""
    docs = pa.concat_arrays([d for d, _ in rows])
    ids = list(chain.from_iterable(i for _, i in rows))
    row, start, length, pieces = [], [], [], []
    for k, own in enumerate(ids):
        for at in range(0, len(own) // 4, capacity):
            piece = own[4 * at : 4 * (at + capacity)]
            row.append(k)
            start.append(at)
            length.append(len(piece) // 4)
            pieces.append(piece)
    windows, offsets = best_fit(length, capacity)
    used = np.bincount(windows, weights=length)
    columns = [
        docs.take(pa.array(row, pa.int64())),
        pa.array(start, pa.int64()),
        pa.array(length, pa.int64()),
        pa.array(pieces, pa.binary()),
        pa.array([len(ids[k]) // 4 for k in row], pa.int64()),
        pa.array([first + w for w in windows], pa.int64()),
        pa.array(offsets, pa.int64()),
        pa.array(((capacity - used) * CLOSED > capacity)[windows], pa.bool_()),
    ]
    names = ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "open"]
    return pa.RecordBatch.from_arrays(columns, names=names), first + max(windows, default=-1) + 1


def _packed_again(capacity: int):
    def run(pieces: pa.Table) -> pa.Table:
        pieces = pieces.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        windows, offsets = best_fit(pieces.column("length").to_pylist(), capacity)
        group = AGAIN | pieces.column("grp")[0].as_py() << 32
        columns = [pieces.column("sequence_id"), pieces.column("offset"), pa.array([group + w for w in windows], pa.int64()), pa.array(offsets, pa.int64())]
        return pa.Table.from_arrays(columns, names=["was", "was_at", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer_path: Callable[[], str], end_id: int, text: str = "text", capacity: int = CAPACITY, carry: list[str] | None = None) -> DataFrame:
    """Pieces of all documents: ``doc`` (struct of the columns in ``carry``, or all but the text,
    which would be repeated with every piece), ``start`` and ``length`` in the document's
    tokens, ``ids`` (little-endian 32-bit numbers), ``doc_tokens``, ``sequence_id`` and
    ``offset``.

    ``tokenizer_path`` is called by the tasks, where the file is.
    """
    kept = [c for c in docs.columns if c != text] if carry is None else carry
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path())
        encode.start()
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            texts, own = batch.column(1).to_pylist(), batch.column(0)
            for a, b in slices(texts):
                ids = [x + end for x in encode(texts[a:b])]
                held.append((pa.concat_arrays([own.slice(a, b - a), own.slice(0, 0)]), ids))
                size += sum(map(len, ids))
                if size >= GROUP:
                    out, number = _packed(held, capacity, number)
                    yield out
                    held, size = [], 0
        if held:
            yield _packed(held, capacity, number)[0]
        encode.rest()

    fields = [("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType())]
    fields.append(("open", T.BooleanType()))
    schema = T.StructType([T.StructField("doc", rows.schema["doc"].dataType), *[T.StructField(n, t) for n, t in fields]])
    pieces = written(rows.mapInArrow(tidy(run), schema), "packed")
    # Only what says where a piece is and how long; the number of groups follows from the ids in all.
    left = pieces.where("open").select("sequence_id", "offset", "length")
    n_groups = 1 + (left.agg(F.sum("length")).first()[0] or 0) * 4 // GROUP
    dealt = left.withColumn("grp", F.pmod(F.xxhash64("sequence_id", "offset"), F.lit(n_groups)))
    moves = dealt.groupBy("grp").applyInArrow(_packed_again(capacity), "was long, was_at long, sequence_id long, offset long")
    names = ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    opened = pieces.where("open").withColumnsRenamed({"sequence_id": "was", "offset": "was_at"}).join(moves, ["was", "was_at"])
    return pieces.where("NOT open").select(*names).unionByName(opened.select(*names))


def word_bpe() -> str:
    """The public word-level BPE's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
