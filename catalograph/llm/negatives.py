"""Hard negatives by Fagin's threshold algorithm.

An anchor's positives are its best rows of the same label. A row of another label is a hard
negative of an anchor and a positive if its score lies in a window set by the positive's
score. Scores are whole-number inner products with the anchor.

Rows are dealt into blocks of bounded size. Within a block every dimension has a list of
the rows, sorted by value. An anchor reads each list from its top or its bottom end, as the
sign of its own component asks, to the same depth in all; dimensions where it is 0 are not read.
Every row met is scored in whole by random access. The values at that depth, weighed by the
anchor, sum up to a threshold that no unmet row exceeds, so reading stops once it is
strictly below, in each window, the score of the k-th best row met, or the window's lower end.
The depth grows by a constant factor, so a block costs few steps.

1. Every block gives each anchor its best rows of the same label; the best of all blocks
   are the positives.
2. The windows that follow go back to the blocks with the anchors; every block gives the first
   rows of each window.

Anchors are a stated set that meets all rows, in blocks; a block gives at most k rows per
anchor and window.

Defined cases: rows whose label or vector is null, or that have a null component, take no
part; vectors of another length than the anchor's take no part with it; ties go to the
smaller id, a null id last; only the anchor's own row is left out, so rows with the same id
are rows like others, and a repeated anchor is asked for each of its rows; an anchor without
positives, or a window without rows, gives no rows; a negative positive score leaves its window
empty; an empty vector scores 0 with another; empty tables give an empty result; other columns are
not read. Sums must fit in 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalograph.llm.common import written

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # hundredths of the positive's score
ANCHOR_BLOCK = 1024
BLOCK = 4096
FIRST_DEPTH, DEEPER = 16, 2
LAST_ID = (1 << 63) - 1  # stands for a null id while rows are compared


class SortedLists:
    """A block of vectors with one list per dimension, sorted by value. Rows are in the order of ids."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(vectors.T, self.order, axis=1)
        # Sums below 2**53 are exact in doubles, which multiply faster.
        self.most = float(np.abs(vectors).max(initial=0)) * max(1, vectors.shape[1])
        self.doubles = vectors.astype(np.float64)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        if self.most * float(np.abs(anchor).max(initial=0)) < 2.0**53:
            return (self.doubles[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ anchor

    def first(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int | None, int | None]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows and scores of the ``k`` best ``allowed`` rows in each window (lowest and highest score,
        both included; None for no limit), from the best on, ties to the first row."""
        n = len(self.vectors)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met = np.zeros(n, bool)
        scores = np.zeros(n, np.int64)
        if not len(up) and not len(down):
            met[:] = True  # every score is 0
        depth = 0
        while not met.all():
            last, depth = depth, min(n, depth * DEEPER or FIRST_DEPTH)
            found = np.zeros(n, bool)
            found[self.order[up, n - depth : n - last].ravel()] = True
            found[self.order[down, last:depth].ravel()] = True
            fresh = np.flatnonzero(found & ~met)
            met[fresh] = True
            scores[fresh] = self.scores(fresh, anchor)
            threshold = int(self.values[up, n - depth] @ anchor[up] + self.values[down, depth - 1] @ anchor[down])
            known = scores[met & allowed]
            if all(self._over(known, threshold, low, high, k) for low, high in windows):
                break
        out = []
        place = np.flatnonzero(met & allowed)
        for low, high in windows:
            rows = place[_within(scores[place], low, high)]
            own = scores[rows]
            if len(rows) > k:  # the k best and their ties
                enough = own >= np.partition(own, len(own) - k)[len(own) - k]
                rows, own = rows[enough], own[enough]
            best = np.argsort(-own, kind="stable")[:k]
            out.append((rows[best], own[best]))
        return out

    @staticmethod
    def _over(known: np.ndarray, threshold: int, low: int | None, high: int | None, k: int) -> bool:
        """Can no row with at most ``threshold`` be among the window's first any more?"""
        if low is not None and threshold < low:
            return True
        return int(np.count_nonzero(known[_within(known, low, high)] > threshold)) >= k


def _within(scores: np.ndarray, low: int | None, high: int | None) -> np.ndarray:
    """Which scores lie in a window? Its ends may exceed 64 bits."""
    if (low is not None and low > LAST_ID) or (high is not None and high < -LAST_ID):
        return np.zeros(len(scores), bool)
    fit = np.ones(len(scores), bool)
    if low is not None and low > -LAST_ID:
        fit &= scores >= low
    if high is not None and high < LAST_ID:
        fit &= scores <= high
    return fit


def _pairs(anchors: pd.DataFrame, rows: pd.DataFrame) -> Iterator[tuple[object, SortedLists, pd.DataFrame]]:
    """Each anchor with the sorted lists and the rows of its length of vector."""
    lengths = rows["vector"].map(len)
    for n, asked in anchors.groupby(anchors["vector"].map(len)):
        met = rows[lengths == n].sort_values("id", kind="stable")
        if len(met):
            lists = SortedLists(np.stack(met["vector"].to_numpy()).reshape(len(met), n).astype(np.int64))
            for anchor in asked.itertuples(index=False):
                yield anchor, lists, met


def _positives(k: int):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for anchor, lists, met in _pairs(anchors, rows) if len(anchors) and len(rows) else ():
            allowed = (met["label"].to_numpy() == anchor.label) & (met["row"].to_numpy() != anchor.row)
            ((places, scores),) = lists.first(np.asarray(anchor.vector, np.int64), allowed, [(None, None)], k)
            out += zip([anchor.row] * len(places), met["id"].to_numpy()[places], scores)
        return pd.DataFrame(out, columns=["row", "id", "score"])

    return run


def _negatives(k: int, low: int, high: int):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for anchor, lists, met in _pairs(anchors, rows) if len(anchors) and len(rows) else ():
            allowed = met["label"].to_numpy() != anchor.label
            # In whole numbers: low * positive <= 100 * negative <= high * positive.
            windows = [(-(-low * int(s) // 100), high * int(s) // 100) for s in anchor.scores]
            found = lists.first(np.asarray(anchor.vector, np.int64), allowed, windows, k)
            for place, (places, scores) in enumerate(found):
                out += zip([anchor.row] * len(places), [place] * len(places), met["id"].to_numpy()[places], scores)
        return pd.DataFrame(out, columns=["row", "place", "id", "score"])

    return run


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1 per anchor and positive), ``negative_id``,
    ``positive_score``, ``negative_score``.

    ``rows`` has ``id`` (long), ``vector`` (array of long) and ``label``. ``low`` and ``high`` are
    hundredths of the positive's score between which a negative's score lies.
    """
    fine = rows.where("label IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL)")
    fine = fine.withColumn("asked", F.coalesce(is_anchor, F.lit(False)))
    fine = fine.select(F.coalesce("id", F.lit(LAST_ID)).alias("id"), "vector", F.col("label").cast("long").alias("label"), "asked")
    rows = written(fine.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    anchors = rows.where("asked").select("row", "id", "vector", "label")
    n_blocks = max(1, -(-rows.count() // BLOCK))
    n_asked = max(1, -(-anchors.count() // ANCHOR_BLOCK))
    # Every block of anchors meets every block of rows once.
    place = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.drop("asked").withColumn("block", place(n_blocks)).withColumn("anchors", every(n_asked))
    dealt = dealt.groupBy("anchors", "block")

    def met(some: DataFrame, work, schema: str) -> DataFrame:
        dealt_anchors = some.withColumn("anchors", place(n_asked)).withColumn("block", every(n_blocks))
        return dealt_anchors.groupBy("anchors", "block").cogroup(dealt).applyInPandas(work, schema)

    def first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    best = first(met(anchors, _positives(positives), "row long, id long, score long"), ["row"], positives)
    in_order = F.array_sort(F.collect_list(F.struct("rank", "id", "score")))
    lists = best.groupBy("row").agg(in_order.alias("best"))  # ``positives`` entries at most
    asked = anchors.join(lists, "row").select("row", F.col("id").alias("anchor"), "vector", "label", F.col("best.id").alias("ids"), F.col("best.score").alias("scores"))
    asked = written(asked, "negatives-anchors")
    found = met(asked, _negatives(negatives, low, high), "row long, place int, id long, score long")
    ranked = first(found, ["row", "place"], negatives)
    known = lambda c: F.when(c != LAST_ID, c)
    return ranked.join(asked.select("row", "anchor", "ids", "scores"), "row").select(
        known(F.col("anchor")).alias("anchor_id"),
        known(F.col("ids")[F.col("place")]).alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        known(F.col("id")).alias("negative_id"),
        F.col("scores")[F.col("place")].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
