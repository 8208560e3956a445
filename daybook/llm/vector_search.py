"""Exact top-k search by MaxScore over shards of integer vectors.

A query's terms are the dimensions it is not zero in. A shard keeps a posting list for each
dimension and sign, and the most and the least value in each dimension, so that a term's
contribution has a bound. Once k candidates are known, the terms with the smallest bounds whose
sum cannot beat the k-th score are non-essential: only vectors on postings of essential terms
are scored, and the others are probed for them while they can still compete.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

SHARD = 8192  # vectors
QUERIES = 4096  # queries a shard works on at once
FIRST = 256  # vectors scored before the first split of terms; the runs grow from there
MOSTLY = 0.75  # share of a run's vectors on essential postings from which all are scored

FOUND = "query_id bigint, vec_id bigint, score bigint"


class Shard:
    """Posting lists of vectors in the order of their ids."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, values = ids[order], values[order]
        self.most = values.max(axis=0, initial=0)
        self.least = values.min(axis=0, initial=0)
        # Whole numbers below 2**53 are exact in floating point, which multiplies faster.
        widest = max(int(self.most.max(initial=0)), -int(self.least.min(initial=0)), 1)
        self.widest = widest * max(1, len(self.most))
        self.whole = values
        self.quick = values.astype(np.float64)
        self.postings = {
            (d, sign): np.flatnonzero(column * sign > 0)
            for d, column in enumerate(values.T)
            for sign in (1, -1)
        }

    def search(self, query_id: int, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best k vectors but the query's own; ties go to the smaller id."""
        n = len(self.ids)
        quick = self.widest * int(abs(weights).max(initial=0)) < 1 << 53
        values = self.quick if quick else self.whole
        weights = weights.astype(values.dtype)
        # At most what a term can add; nothing, where a vector is not on its posting.
        bounds = np.maximum(np.maximum(weights * self.most, weights * self.least), 0)
        terms = np.argsort(bounds, kind="stable")
        rising = np.cumsum(bounds[terms])
        ids, scores = np.zeros(0, np.int64), np.zeros(0, rising.dtype)
        start, size = 0, max(FIRST, 2 * k)
        while start < n:
            end = min(n, start + size)
            floor = scores[-1] if len(scores) == k else None
            if floor is None:
                places = np.arange(start, end)
                gained = values[start:end] @ weights
            else:
                # Later ids lose ties, so a candidate has to beat the floor.
                idle = int(np.searchsorted(rising, floor, side="right"))
                essential, rest = terms[idle:], terms[:idle][::-1]
                if not len(essential):
                    break
                # Below zero even vectors on no posting compete.
                touched = np.full(end - start, floor < 0)
                for d in essential[::-1]:
                    posting = self.postings[d, 1 if weights[d] > 0 else -1]
                    a, b = np.searchsorted(posting, (start, end))
                    touched[posting[a:b] - start] = True
                    if floor < 0 or np.count_nonzero(touched) > MOSTLY * len(touched):
                        touched[:] = True  # to score the few others costs less than to leave them out
                        break
                counted = np.zeros_like(weights)
                counted[essential] = weights[essential]
                gained = values[start:end] @ counted
                able = touched & (gained + (rising[idle - 1] if idle else 0) > floor)
                gained, places = gained[able], np.flatnonzero(able) + start
                left = rising[idle - 1] if idle else 0
                for at, d in enumerate(rest):
                    if at % 4 == 0 and at:
                        able = gained + left > floor
                        places, gained = places[able], gained[able]
                    if not len(places):
                        break
                    gained = gained + weights[d] * values[places, d]
                    left -= bounds[d]
            found = self.ids[places]
            other = found != query_id
            ids = np.concatenate([ids, found[other]])
            scores = np.concatenate([scores, gained[other]])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            start, size = end, 4 * size
        return ids, scores.astype(np.int64)


def _searcher(k: int) -> Callable:
    def run(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, ...]] = []
        if len(vectors) and len(queries):
            width = max(vectors["vector"].map(len).max(), queries["vector"].map(len).max())

            def matrix(rows: pd.Series) -> np.ndarray:
                made = np.zeros((len(rows), width), np.int64)
                for at, v in enumerate(rows):
                    made[at, : len(v)] = v
                return made

            shard = Shard(vectors["vec_id"].to_numpy(), matrix(vectors["vector"]))
            for query_id, weights in zip(queries["vec_id"].to_numpy(), matrix(queries["vector"])):
                ids, scores = shard.search(query_id, weights, k)
                out.append((np.full(len(ids), query_id), ids, scores))
        columns = [np.concatenate([np.zeros(0, np.int64), *c]) for c in (zip(*out) if out else [()] * 3)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    return run


def integers(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, vector): floor(scale * x) of each component.

    Vectors that are NULL, or hold NULL or a number that is not finite, and those without vec_id
    take no part. Of rows that repeat a vec_id the one with the smallest vector counts.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v * scale).cast("bigint"))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & sound)
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("vector")).groupBy("vec_id").agg(
        F.min("vector").alias("vector")
    )


def top(vectors: DataFrame, queries: DataFrame, k: int = 20, shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best vectors by inner product, its own id aside.

    Both take (vec_id, vector); a shorter vector counts as filled up with zeros. Every shard of
    vectors meets every block of queries, and the shards' best are merged.
    """
    shards = max(1, -(-vectors.count() // shard))
    blocks = max(1, -(-queries.count() // block))

    def dealt(rows: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        return rows.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        )

    found = (
        dealt(vectors, "shard", shards, "block", blocks)
        .groupBy("shard", "block")
        .cogroup(dealt(queries, "block", blocks, "shard", shards).groupBy("shard", "block"))
        .applyInPandas(_searcher(k), FOUND)
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
