"""Near-duplicates by SimHash: fingerprints linked by BK-trees, then connected components.

Fingerprints within ``radius`` bits are found without comparing all pairs. The 64 bits
are cut into ``radius + 2`` blocks; two fingerprints that close agree in at least two
blocks, so every pair meets in a shard keyed by some two blocks and their bits. Each
shard holds a BK-tree, whose children are keyed by their integer Hamming distance to
the parent; a search follows only edges within the radius of its own distance. Trees
travel with their shard rather than by broadcast, because all trees together grow with
the corpus. A shard above ``TREE`` fingerprints is dealt to several trees, each searched
by all of the shard, so no task gets an unbounded tree.

Exact copies share a fingerprint and count once throughout. Components are found by
alternating large-star and small-star steps over links, written to the shared folder
after each step.

Defined cases: a null or empty text has fingerprint zero, linked like any other; fewer
words than a shingle make one shingle; rows that repeat a doc_id keep their own
fingerprints; a null doc_id is never a component's smallest unless it is the only one;
empty tables give empty results; other columns travel in the struct ``doc``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm.common import partitions, tidy, written

SEED = 42
TREE = 2000  # fingerprints in one tree
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of a text's word shingles, as a signed number."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes) - 1
        starts = ends + 1 - sizes
        spans = zip(starts.tolist(), ends[shingle - 1 :].tolist())
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans]
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), CHUNK):
        part = np.array(hashes[k : k + CHUNK], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_column(text: Column, shingle: int) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return F.pandas_udf(tidy(run), "long")(text)


class BkTree:
    """A BK-tree over distinct 64-bit fingerprints, searched with many at once."""

    def __init__(self, prints: np.ndarray):
        self.root = prints[0]
        self.children: dict[int, BkTree] = {}
        rest = prints[1:]
        if len(rest):
            edges = np.bitwise_count(rest ^ self.root)
            for edge in np.unique(edges):
                self.children[int(edge)] = BkTree(rest[edges == edge])

    def search(self, prints: np.ndarray, radius: int) -> Iterator[tuple[np.uint64, np.ndarray]]:
        """Each node with the places in ``prints`` that lie within the radius of it."""
        todo = [(self, np.arange(len(prints)))]
        while todo:
            node, at = todo.pop()
            distance = np.bitwise_count(prints[at] ^ node.root).astype(np.int16)
            yield node.root, at[distance <= radius]
            for edge, child in node.children.items():
                near = at[np.abs(distance - edge) <= radius]
                if len(near):
                    todo.append((child, near))


def shard_links(nodes: np.ndarray, searched: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what a tree over ``nodes`` finds for ``searched``: each fingerprint of a
    component to its smallest one."""
    prints = np.unique(np.concatenate([nodes, searched]))
    label = np.arange(len(prints))
    places = np.searchsorted(prints, searched)
    for root, found in BkTree(nodes).search(searched, radius):
        own = label[np.searchsorted(prints, root)]
        old = np.unique(label[places[found]])
        old = old[old != own]
        if len(old):
            low = min(own, old[0])
            label[np.isin(label, old) | (label == own)] = low
    linked = label != np.arange(len(prints))
    return prints[linked], prints[label[linked]]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Fingerprints and node marks of one shard's tree after the other; rows come sorted."""
    kept: list[np.ndarray] = []
    columns = ("part", "bits", "sub", "rest", "tree", "print", "is_node")
    for batch in batches:
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        if kept:
            now = [np.concatenate(x) for x in zip(kept, now)]
        if not len(now[0]):
            continue
        new = np.logical_or.reduce([np.diff(x) != 0 for x in now[:-2]])
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        sizes = np.diff(starts)
        for k in np.flatnonzero(sizes > 1):  # a lone fingerprint has no link
            at = slice(starts[k], starts[k + 1])
            yield now[-2][at].view(np.uint64), now[-1][at]
        kept = [x[starts[-1] :] for x in now]
    if kept and len(kept[0]) > 1:
        yield kept[-2].view(np.uint64), kept[-1]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _rest_masks(mask: int, n: int) -> list[int]:
    """The bits outside ``mask``, from the lowest on, in ``n`` about equal parts."""
    free = [b for b in range(64) if not mask >> b & 1]
    edges = np.linspace(0, len(free), n + 1).astype(int)
    return [sum(1 << b for b in free[x:y]) for x, y in zip(edges, edges[1:])]


def links(prints: DataFrame, radius: int) -> DataFrame:
    """``(a, b)`` links that connect all fingerprints within ``radius`` bits of each other;
    ``prints`` has one row per distinct fingerprint ``print``."""
    spark = prints.sparkSession
    edges = np.linspace(0, 64, radius + 3).astype(int)
    masks = [sum(((1 << int(edges[b + 1])) - (1 << int(edges[b]))) for b in pair) for pair in combinations(range(radius + 2), 2)]
    at = lambda m: F.col("print").bitwiseAND(F.lit(_signed(m)).cast("long"))
    rows = prints.select("print", F.posexplode(F.array(*[at(m) for m in masks])).alias("part", "bits"))

    def crowded(by: list[str]) -> DataFrame:
        sizes = rows.groupBy(*by).count().where(F.col("count") > TREE)
        return written(sizes.withColumn("trees", F.ceil(F.col("count") / TREE).cast("int")).drop("count"), "simhash-large")

    # All bits that may differ lie outside a shard's own: cut into one part more than may differ, two
    # fingerprints within the radius agree in one of them. So a crowded shard is parted again.
    large = crowded(["part", "bits"])
    if large.isEmpty():
        rows = rows.select("*", F.lit(0).alias("sub"), F.lit(0).cast("long").alias("rest"), F.lit(1).alias("trees"))
    else:
        parts = [F.array(*[at(m) for m in _rest_masks(mask, radius + 1)]) for mask in masks]
        again = F.element_at(F.array(*parts), F.col("part") + 1)
        alone = F.array(F.lit(0).cast("long"))
        rows = rows.join(large.withColumnRenamed("trees", "many"), ["part", "bits"], "left")
        rows = rows.select("print", "part", "bits", F.posexplode(F.when(F.col("many").isNull(), alone).otherwise(again)).alias("sub", "rest"))
        # What is crowded even then is searched by several trees.
        by = ["part", "bits", "sub", "rest"]
        rows = rows.join(crowded(by), by, "left").withColumn("trees", F.coalesce("trees", F.lit(1)))
    shard = ["part", "bits", "sub", "rest", "tree"]
    rows = rows.select(*shard[:-1], "print", "trees", F.explode(F.expr("sequence(0, trees - 1)")).alias("tree"))
    rows = rows.withColumn("is_node", F.pmod(F.xxhash64("print"), F.col("trees")) == F.col("tree")).select(*shard, "print", "is_node")
    dealt = rows.repartition(partitions(spark), *shard).sortWithinPartitions(*shard, "print")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, is_node in _shards(batches):
            nodes = found[is_node]
            if len(nodes):
                a, b = shard_links(nodes, found, radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return dealt.mapInArrow(tidy(run), "a long, b long").distinct()


def _normal(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)``: each linked vertex that is not the smallest of its component, with the smallest."""
    now = written(_normal(edges), "simhash-links")
    before = None
    while True:
        # Large star: neighbours above a vertex go to its smallest neighbour.
        both = now.union(now.select(F.col("b"), F.col("a")))
        # Smallest neighbours are written: their join then has two plain shuffles, and Spark splits a vertex that
        # holds many edges.
        least = written(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).withColumn("m", F.least("m", "v")), "simhash-least")
        now = written(_normal(both.where("b > a").join(least, F.col("a") == F.col("v")).select(F.col("b").alias("a"), F.col("m").alias("b"))), "simhash-links")
        # Small star: neighbours below a vertex, and itself, go to the smallest of them.
        least = written(now.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")), "simhash-least")
        joined = now.join(least, F.col("a") == F.col("v"))
        now = written(_normal(joined.select("b", "m").toDF("a", "b").union(least.toDF("a", "b"))), "simhash-links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now
        before = state


def _grouped(docs: DataFrame, text: str, doc_id: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Written: ``(id, print)`` of every row, and ``(print, first, root)`` of every fingerprint with its
    smallest id and the fingerprint that names its component."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), fingerprint_column(F.col(f"`{text}`"), shingle).alias("print"))
    rows = written(rows, "simhash-prints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id"))
    firsts = written(rows.groupBy("print").agg(first.alias("first")), "simhash-distinct")
    stars = components(links(firsts.select("print"), radius))
    rooted = firsts.join(stars.toDF("print", "root"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    return rows, written(rooted, "simhash-roots")


def _with_prints(docs: DataFrame, text: str, doc_id: str, shingle: int) -> DataFrame:
    """Every row as the struct ``doc``, with ``id`` and ``print``. Fingerprints are computed again
    rather than read from a second copy of all texts."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return docs.select(doc, F.col(f"`{doc_id}`").alias("id"), fingerprint_column(F.col(f"`{text}`"), shingle).alias("print"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4, radius: int = 4, carry: bool = True) -> DataFrame:
    """``doc`` (struct of all columns, or of the id alone without ``carry``), ``print`` (fingerprint as
    a signed number) and ``component_id`` (smallest id reachable over links) of every row."""
    rows, rooted = _grouped(docs, text, doc_id, shingle, radius)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = rooted.join(smallest, "root").select("print", F.col("least.id").alias("component_id"))
    if carry:
        rows = _with_prints(docs, text, doc_id, shingle)
    else:
        rows = rows.withColumn("doc", F.struct(F.col("id").alias(doc_id)))
    return rows.join(named, "print").select("doc", "print", "component_id")


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of each component: the one with the smallest id, and where rows repeat that id and
    fingerprint, the one whose text has the smallest hash."""
    _, rooted = _grouped(docs, text, doc_id, shingle, radius)
    own = F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("own")
    least = rooted.groupBy("root").agg(F.min(F.struct("first", "print")).alias("least"))
    kept = least.select("least.print", "least.first.id").select("print", own)
    rows = _with_prints(docs, text, doc_id, shingle).select("doc", "print", own, F.xxhash64(f"doc.`{text}`").alias("tie"))
    # Equal ids with equal fingerprints are few; they meet where the join has put them.
    one = rows.join(kept, ["print", "own"]).groupBy("print", "own").agg(F.min_by("doc", "tie").alias("doc"))
    return one.select("doc.*")


def hex_digits(prints: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(prints), 16, "0"))
