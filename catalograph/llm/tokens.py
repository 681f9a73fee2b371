"""Count tokens per section of a document.

Every document is encoded once, whole, so that counts add up to the document's own. The
tokenizer is byte-level: tokens' byte lengths, summed up, are their spans in the text.
Token spans are joined to section spans as intervals, and a token that crosses a
boundary goes to the section that holds most of its bytes; among equals to the first.
Bytes outside all sections count as a section of their own, number -1.

Sections are given as character ranges that neither overlap nor go back. Without them
the lines of a text are its sections, a line end belonging to the line it ends.

Defined cases: a null or empty text has no lines and no tokens and gives no rows; a section
without characters has 0 tokens; ranges outside the text are cut to it; repeated rows
are counted each; an empty table gives an empty result; other columns travel in the
struct ``doc``.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@cache
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


def byte_bpe() -> tuple[str, str]:
    """File and splitting pattern of the public byte-level BPE on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def attributed(ends: np.ndarray, starts: np.ndarray, stops: np.ndarray, n_bytes: int) -> tuple[np.ndarray, int]:
    """Tokens of each section, and of none, given where tokens end and sections start and stop, in bytes."""
    # The text as intervals in order: a gap before each section, the section, the last gap.
    edges = np.empty(2 * len(starts) + 2, np.int64)
    edges[0], edges[-1] = 0, n_bytes
    edges[1:-1:2], edges[2:-1:2] = starts, stops
    begins = np.concatenate([[0], ends[:-1]])
    low = np.searchsorted(edges, begins, side="right") - 1
    high = np.searchsorted(edges, ends, side="left") - 1
    # Odd intervals are sections, even ones lie outside.
    owner = np.where(low % 2 == 1, low // 2, -1)
    for at in np.flatnonzero(high > low):  # the few that cross a boundary
        held: dict[int, int] = {}
        for k in range(low[at], high[at] + 1):
            section = k // 2 if k % 2 else -1
            held[section] = held.get(section, 0) + min(edges[k + 1], ends[at]) - max(edges[k], begins[at])
        owner[at] = max(held, key=held.get)  # of equals the one met first
    counts = np.bincount(owner + 1, minlength=len(starts) + 1)
    return counts[1:], int(counts[0])


def _line_starts(data: np.ndarray) -> np.ndarray:
    breaks = np.flatnonzero(data == 10) + 1
    return np.concatenate([[0], breaks[breaks < len(data)]])


def token_counts(docs: DataFrame, text: str = "text", sections: Column | None = None, tokenizer: Callable[[], tuple[str, str]] = byte_bpe, carry: list[str] | None = None) -> DataFrame:
    """``doc``, ``section`` (number from 0, -1 for none), ``start`` and ``end`` (characters; null for
    none), ``n_tokens`` and ``doc_tokens``, a row per section and one for bytes outside that have tokens.

    ``sections``: an array of structs ``start``, ``end``. ``tokenizer`` is called by the tasks.
    """
    kept = docs.columns if carry is None else carry
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        (F.lit(None) if sections is None else sections).cast("array<struct<start:int,end:int>>").alias("sections"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = _encoding(*tokenizer())
        for batch in batches:
            own: list[int] = []
            out: list[list[np.ndarray]] = []
            for row, (body, spans) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                data = np.frombuffer(body.encode(), np.uint8)
                ends = np.cumsum(sizes[np.array(encoding.encode_ordinary(body), np.int64)]) if body else np.zeros(0, np.int64)
                chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # byte of each character
                if spans is None:
                    first = _line_starts(data) if len(data) else np.zeros(0, np.int64)
                    stop = np.append(first[1:], len(data)) if len(data) else first
                else:
                    cut = np.array([(s["start"], s["end"]) for s in spans], np.int64).reshape(-1, 2).clip(0, len(chars) - 1)
                    first, stop = chars[cut[:, 0]], chars[cut[:, 1]]
                if not len(ends) and not len(first):
                    continue
                counts, rest = attributed(ends, first, stop, len(data)) if len(ends) else (np.zeros(len(first), np.int64), 0)
                number = np.arange(len(first))
                at, to = np.searchsorted(chars, first), np.searchsorted(chars, stop)
                if rest:
                    number, at, to, counts = (np.append(x, y) for x, y in ((number, -1), (at, -1), (to, -1), (counts, rest)))
                own += [row] * len(number)
                out.append([number, at, to, counts, np.full(len(number), len(ends))])
            if own:
                columns = [np.concatenate(x) for x in zip(*out)]
                none = columns[0] < 0
                arrays = [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int32(), mask=none) for c in columns[1:3]), *(pa.array(c, pa.int64()) for c in columns[3:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), *arrays], names=names)

    names = ["doc", "section", "start", "end", "n_tokens", "doc_tokens"]
    kinds = [T.IntegerType(), T.IntegerType(), T.IntegerType(), T.LongType(), T.LongType()]
    schema = T.StructType([T.StructField("doc", rows.schema["doc"].dataType), *[T.StructField(n, k) for n, k in zip(names[1:], kinds)]])
    return rows.mapInArrow(run, schema)
