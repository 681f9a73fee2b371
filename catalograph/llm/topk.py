"""Exact top-k inner products by a three-phase uniform threshold.

A vector's dimensions are parted into ``slices``; a score is the sum of its slices'
partial scores. Queries and candidates meet in blocks of fixed size.

1. Every block gives, for each query and slice, the ``k`` best partial scores, with the
   totals they belong to. The k-th best total gathered is a safe cutoff: at least ``k``
   candidates reach it.
2. The cutoff goes back to the blocks with the query. A total that reaches it has, in some
   slice, a partial score of at least cutoff / slices; only those entries are collected.
3. The other slices of the collected entries are added, so their scores are exact, and
   each block hands on its best ``k``.

Scores are whole numbers. They are computed in doubles, which are exact up to 2**53, or
in 64-bit integers where a block could exceed that.

Defined cases: vectors that are null, empty of meaning (a null component) or of
another length than the query's take no part with it; a query with fewer than ``k``
candidates gets all; ties go to the smaller id, a null id last; only the query's own row is
never its candidate, so rows that repeat its id are, and each of them is a query of its own;
repeated candidates count each; empty tables give an empty result; no other columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalograph.llm.common import written

SLICES = 2
NO_CUTOFF = -(1 << 62)  # of a query with fewer than k candidates: all reach it
QUERY_BLOCK = 1024
BLOCK = 4096
LAST_ID = (1 << 63) - 1  # stands for a null id while rows are compared


def whole_vector(vector: Column, scale: float = 256.0) -> Column:
    """``floor(scale * x)`` of every component; null if any is null or not finite."""
    doubles = vector.cast("array<double>")
    fine = F.forall(doubles, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.when(fine, F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _matrices(queries: pd.DataFrame, rows: pd.DataFrame):
    """Ids and vectors of queries and rows, one length of vector after the other; rows by id."""
    lengths = rows["vector"].map(len).to_numpy()
    asked = queries["vector"].map(len).to_numpy()
    for n in np.unique(asked):
        q, c = queries[asked == n], rows[lengths == n].sort_values("id", kind="stable")
        if len(c):
            vectors = (np.stack(x["vector"].to_numpy()).reshape(len(x), n) for x in (q, c))
            yield q, next(vectors), c["row"].to_numpy(), c["id"].to_numpy(), next(vectors)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of a row, ties to the first."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, equal = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        return np.concatenate([above, equal[: k - len(above)]])
    return np.arange(len(scores))


def _parts(n: int, slices: int) -> list[slice]:
    edges = np.linspace(0, n, slices + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _cutoffs(k: int, slices: int):
    """Phase 1: totals of each slice's best partial scores."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for q, asked, places, _, vectors in _matrices(queries, rows) if len(queries) and len(rows) else ():
            partial = [_products(asked[:, p], vectors[:, p]) for p in _parts(asked.shape[1], slices)]
            for row, own in enumerate(q["row"].to_numpy()):
                there = np.flatnonzero(places != own)
                found = np.unique(np.concatenate([there[_best(p[row, there], k)] for p in partial]))
                totals = np.sort(sum(p[row, found] for p in partial))[::-1][:k]
                out.append((own, totals.tolist()))
        return pd.DataFrame(out, columns=["row", "totals"])

    return run


def _entries(k: int, slices: int):
    """Phases 2 and 3: entries that may reach the cutoff, with exact scores."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for q, asked, places, ids, vectors in _matrices(queries, rows) if len(queries) and len(rows) else ():
            partial = [_products(asked[:, p], vectors[:, p]) for p in _parts(asked.shape[1], slices)]
            for row, (own, cutoff) in enumerate(zip(q["row"].to_numpy(), q["cutoff"].to_numpy())):
                # In whole numbers: a slice reaches cutoff / slices, rounded up.
                enough = np.logical_or.reduce([p[row] >= -(-cutoff // slices) for p in partial])
                there = np.flatnonzero(enough & (places != own))
                totals = sum(p[row, there] for p in partial)
                best = _best(totals, k)
                out += [(own, i, s) for i, s in zip(ids[there[best]].tolist(), totals[best].tolist())]
        return pd.DataFrame(out, columns=["row", "id", "score"])

    return run


def top_k(rows: DataFrame, is_query: Column, k: int = 5, slices: int = SLICES) -> DataFrame:
    """``query_id``, ``rank``, ``id``, ``score``: the ``k`` best other ``rows`` of every row that is a query.

    ``rows`` has ``id`` (long) and ``vector`` (array of long).
    """
    fine = rows.where("vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL)").withColumn("asked", F.coalesce(is_query, F.lit(False)))
    fine = fine.select(F.monotonically_increasing_id().alias("row"), F.coalesce("id", F.lit(LAST_ID)).alias("id"), "vector", "asked")
    rows = written(fine, "topk-rows")
    queries = rows.where("asked").select("row", "id", "vector")
    n_blocks = max(1, -(-rows.count() // BLOCK))
    n_asked = max(1, -(-queries.count() // QUERY_BLOCK))
    # Every query block meets every block of rows once.
    place = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    spread = rows.drop("asked").withColumn("block", place(n_blocks)).withColumn("queries", every(n_asked)).groupBy("queries", "block")

    def met(some: DataFrame, work, schema: str) -> DataFrame:
        dealt = some.withColumn("queries", place(n_asked)).withColumn("block", every(n_blocks))
        return dealt.groupBy("queries", "block").cogroup(spread).applyInPandas(work, schema)

    lists = met(queries, _cutoffs(k, slices), "row long, totals array<long>")
    falling = Window.partitionBy("row").orderBy(F.desc("cutoff"))
    ranked = lists.select("row", F.explode("totals").alias("cutoff")).withColumn("rank", F.row_number().over(falling))
    cutoffs = ranked.where(F.col("rank") == k).drop("rank")
    asked = queries.join(cutoffs, "row", "left").withColumn("cutoff", F.coalesce("cutoff", F.lit(NO_CUTOFF)))
    asked = written(asked, "topk-cutoffs")
    found = met(asked, _entries(k, slices), "row long, id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    first = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    known = lambda c: F.when(c != LAST_ID, c)
    named = first.join(asked.select("row", F.col("id").alias("query_id")), "row")
    return named.select(known(F.col("query_id")).alias("query_id"), "rank", known(F.col("id")).alias("id"), "score")
