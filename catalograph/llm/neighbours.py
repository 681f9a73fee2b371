"""Quality by the votes of nearest labelled neighbours in a latent-semantic space.

A text is a bag of terms that any language has: sequences of four marks of its shape (runs of small
letters, capitals, digits or white space are one mark each, every other sign is one), words equal to one of the two
before them, and lines met before. Term frequencies are square roots of relative counts, weighed by
the inverse document frequency in the sample; a truncated singular value decomposition of the
sample's matrix gives ``DIMENSIONS`` latent directions, and a text's vector has length 1.

The labelled sample's vectors go to all tasks. A task multiplies its documents with all of them, block
by block; a document's ``NEIGHBOURS`` best cosines, and what ties with the last of them, vote for their label,
weighed by the cosine and by how many labelled documents a sampled one stands for.

The model is learned from at most ``sample`` labelled documents, half of them of each label (or all that
there are), chosen by a hash. This bound is a parameter; it bounds the model, what is broadcast and the driver's work.
Scores cover every whole text.

Defined cases: documents without a label, with a null key or a null text are not learned from; a key with
several labels has the smallest; a null or empty text, or one that shares no term with the sample,
gets the share of label 1 among all labelled keys (0.5 if nothing could be learned, for every text); very long texts are read
in parts; repeated rows get the same score; an empty table gives an empty result; other columns
travel in the struct ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalograph.llm.common import tidy

SAMPLE = 4000
DIMENSIONS = 48
NEIGHBOURS = 9
BUCKETS = 4096  # of shape sequences
TERMS = BUCKETS + 3
REPEATED = 3.0  # a repeated word or line counts as so many shape sequences
PART = 1 << 20  # characters read at once
BLOCK = 256  # documents multiplied at once
ROUNDS = 4  # of the decomposition's subspace iteration

_MARKS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\x0b\x0c\r", "\n", ".", ",;:", "!?", "'\"`", "#*", "$%&", "|", "<>", "()[]{}/\\", "-_=+~^@"]
_MARK_OF = np.zeros(256, np.uint8)  # other bytes: letters beyond ASCII are mark 0 too
for _mark, _chars in enumerate(_MARKS):
    _MARK_OF[[ord(c) for c in _chars]] = _mark
_RUNS = 4  # the first marks count once a run


def _parts(text: str) -> Iterator[str]:
    """The text in parts that end between words, where there are any."""
    at = 0
    while len(text) - at > PART:
        stop = max(text.rfind(" ", at + 1, at + PART), text.rfind("\n", at + 1, at + PART))
        stop = at + PART if stop < 0 else stop
        yield text[at:stop]
        at = stop
    yield text[at:]


def term_counts(text: str | None) -> np.ndarray:
    """How often each term occurs in a text."""
    counts = np.zeros(TERMS)
    before = np.zeros(0, np.uint32)  # the marks that the next part's sequences begin with
    words_before: list[str] = []
    for part in _parts(text or ""):
        marks = _MARK_OF[np.frombuffer(part.encode(), np.uint8)].astype(np.uint32)
        marks = np.concatenate([before, marks])
        if len(marks):
            first = np.ones(len(marks), bool)
            first[1:] = (marks[1:] != marks[:-1]) | (marks[1:] >= _RUNS)
            marks = marks[first]
        if len(marks) > 3:
            codes = ((marks[:-3] << 4 | marks[1:-2]) << 4 | marks[2:-1]) << 4 | marks[3:]
            buckets = (codes * np.uint32(2654435761)) >> np.uint32(20)
            counts[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
        before = marks[-3:]
        words = words_before + part.split()
        known = len(words_before)
        counts[BUCKETS] += sum(map(str.__eq__, words[max(known, 1) :], words[max(known, 1) - 1 :]))
        counts[BUCKETS + 1] += sum(map(str.__eq__, words[max(known, 2) :], words[max(known, 2) - 2 :]))
        words_before = words[-2:]
    lines = [line for line in (text or "").split("\n") if line.strip()]
    counts[BUCKETS + 2] = len(lines) - len(set(lines))
    counts[BUCKETS:] *= REPEATED
    return counts


@dataclass
class Model:
    idf: np.ndarray  # per term
    directions: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # sampled documents x dimensions
    labels: np.ndarray  # 1 for label 1, else 0
    weights: np.ndarray  # labelled keys that a sampled document stands for
    prior: float

    def embed(self, counts: np.ndarray) -> np.ndarray:
        """Vectors of length 1 (0 for texts without known terms) from rows of term counts."""
        shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        return _unit((np.sqrt(shares) * self.idf) @ self.directions)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of label 1 among the weighed votes."""
        if not len(self.vectors):
            return np.full(len(counts), self.prior)
        cosines = self.embed(counts) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.vectors))
        last = np.partition(cosines, -k, axis=1)[:, -k, None]
        votes = np.where(cosines >= last - 1e-9, np.maximum(cosines, 0), 0) * self.weights
        total = votes.sum(axis=1)
        return np.where(total > 0, (votes @ self.labels) / np.where(total > 0, total, 1), self.prior).round(9)


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.where(size > 1e-12, rows / np.maximum(size, 1e-12), 0)


def decomposed(matrix: np.ndarray, dimensions: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from fixed random directions."""
    width = min(dimensions + 16, *matrix.shape)
    basis = np.random.default_rng(0).standard_normal((matrix.shape[1], width))
    for _ in range(ROUNDS):
        basis = np.linalg.qr(matrix.T @ np.linalg.qr(matrix @ basis)[0])[0]
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ right.T)[:, :dimensions]


def fitted(counts: np.ndarray, labels: np.ndarray, weights: np.ndarray, prior: float, dimensions: int = DIMENSIONS) -> Model:
    """A model of labelled documents given by their term counts."""
    met = (counts > 0).sum(axis=0)
    model = Model(np.log((1 + len(counts)) / (1 + met)) + 1, np.zeros((counts.shape[1], 0)), np.zeros((0, 0)), labels, weights, prior)
    if not len(counts):
        return model
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    model.directions = decomposed(np.sqrt(shares) * model.idf, dimensions)
    model.vectors = model.embed(counts)
    return model


def train(docs: DataFrame, labels: DataFrame, key: str, text: str = "text", sample: int = SAMPLE) -> Model:
    """A model of at most ``sample`` documents that have a label; ``labels`` has ``key`` and ``label``."""
    known = labels.where(F.col(key).isNotNull() & F.col("label").isNotNull()).groupBy(key).agg((F.min("label") == 1).cast("int").alias("label"))
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows at most
    if not sizes:
        return fitted(np.zeros((0, TERMS)), np.zeros(0), np.zeros(0), 0.5)
    fewest = min(sizes.values()) if len(sizes) > 1 else 0
    part = {name: min(n, max(sample // 2, sample - fewest)) for name, n in sizes.items()}
    place = [F.xxhash64(F.col(key).cast("string")), F.col(key)]
    chosen = [known.where(F.col("label") == name).orderBy(*place).limit(n) for name, n in part.items()]
    chosen = chosen[0].unionByName(chosen[1]) if len(chosen) > 1 else chosen[0]
    # At most ``sample`` rows, so it is safe to broadcast.
    found = docs.select(key, text).where(F.col(text).isNotNull()).join(F.broadcast(chosen), key).select(F.col(text).alias("text"), "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [term_counts(t) for t in batch.column(0).to_pylist()]
            terms = [np.flatnonzero(c) for c in counts]
            columns = [pa.array(terms, pa.list_(pa.int32())), pa.array([c[t] for c, t in zip(counts, terms)], pa.list_(pa.float64())), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, names=["terms", "counts", "label"])

    # A key may have several documents: still at most ``sample`` of them.
    rows = found.mapInArrow(tidy(count), "terms array<int>, counts array<double>, label int")
    rows = rows.orderBy(F.xxhash64("terms", "counts"), "label").limit(sample).toPandas()
    counts = np.zeros((len(rows), TERMS))
    for k, (terms, own) in enumerate(zip(rows["terms"], rows["counts"])):
        counts[k, terms] = own
    y = rows["label"].to_numpy(np.float64)
    stands_for = {name: sizes[name] / max(1, int((y == name).sum())) for name in sizes}
    weights = np.array([stands_for[int(label)] for label in y], np.float64)
    return fitted(counts, y, weights, sizes.get(1, 0) / sum(sizes.values()))


def classified(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``doc`` and ``score`` (0 to 1, higher where label 1 is likelier) of every document."""
    kept = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # ``sample`` vectors and TERMS directions at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                scores = sent.value.score(np.stack([term_counts(t) for t in some.column(1).to_pylist()]))
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(scores, pa.float64())], names=["doc", "score"])

    schema = T.StructType([T.StructField("doc", rows.schema["doc"].dataType), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(tidy(run), schema)
