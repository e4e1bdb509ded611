"""Exact top-k search by sorted lists without random access (NRA).

A vector has one entry in the sorted list of each dimension. For a query the
score is a weighted sum over the lists, read from the end at which the weight
times the entry is largest. After some depth every list has a threshold t_j,
the largest weighted entry that it can still give, and a smallest one l_j. A
vector seen in some lists has

    lower bound  = seen entries + sum of l_j over the lists it was not seen in,
    upper bound  = seen entries + sum of t_j over those lists.

Reading stops when the k-th best lower bound is above the upper bound of every
vector outside; the scores of those left are resolved exactly.

On Spark the candidates are dealt into shards of bounded size and width, each
stored once as its sorted lists. Queries come in slices of bounded size, one
pass over the shards per slice. A task keeps the best lower bounds of a query
from one shard to the next, gives ``k`` rows per query, and these are ranked
per query. Copies of one vector lie in different shards, so a hot vector is
spread; no pair of rows is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm.common import bucket, by_value, pieces, stored

by_value(__name__)

# Vectors of a shard, and queries of a slice.
SHARD = 4096
SLICE = 4096
# Queries whose bounds a task holds at a time.
AT_ONCE = 512
# Sums below this are exact in float64.
EXACT = float(2**53)

LISTS = "width int, ids binary, order binary, matrix binary"
HITS = "query_id long, vec_id long, score long"


def whole_numbers(embedding: str | Column) -> Column:
    """floor(256 x) of each component as longs; NULL for a vector that takes no part.

    Null and empty vectors and those with a null, infinite or NaN component take no part.
    """
    values = F.col(embedding) if isinstance(embedding, str) else embedding
    usable = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    numbers = F.transform(values, lambda x: F.floor(x.cast("double") * 256).cast("long"))
    return F.when((F.size(values) > 0) & usable, numbers)


def sorted_lists(rows: pd.DataFrame) -> pd.DataFrame:
    """A shard: vectors of one width, and for each dimension their positions by ascending entry."""
    rows = rows.sort_values("vec_id", kind="stable")
    matrix = np.array(rows["vector"].tolist(), np.int64)
    order = np.argsort(matrix, axis=0, kind="stable").T.astype(np.int32)
    return pd.DataFrame({
        "width": [matrix.shape[1]], "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()],
        "order": [np.ascontiguousarray(order).tobytes()], "matrix": [matrix.tobytes()],
    })


def depths(n: int) -> list[int]:
    """How far the lists are read before bounds are looked at."""
    return sorted({max(1, n // 8), max(1, n // 4), max(1, n // 2), max(1, 3 * n // 4)})


class Lists:
    """The sorted lists of one shard, read to the same depth for many queries at a time."""

    def __init__(self, width: int, ids: bytes, order: bytes, matrix: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.matrix = np.frombuffer(matrix, np.int64).reshape(-1, width)
        order = np.frombuffer(order, np.int32).reshape(width, -1)
        self.entries = np.take_along_axis(self.matrix.T, order, axis=1)
        self.rank = np.empty(self.matrix.shape, np.int32)
        self.rank[order.T, np.arange(width)[None, :]] = np.arange(len(self.ids))[:, None]

    def bounds(self, depth: int, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (row x query) once every list was read to ``depth``.

        ``up`` and ``down`` hold the positive and negative weights (dimension x
        query); a positive weight reads a list from its largest entry, a
        negative one from its smallest.
        """
        n, kind = len(self.ids), up.dtype
        x = self.matrix.astype(kind)
        small, large = (self.entries[:, at].astype(kind)[None, :] for at in (0, -1))
        from_top, from_bottom = self.rank >= n - depth, self.rank < depth
        last_top, last_bottom = (self.entries[:, at].astype(kind)[None, :] for at in (n - depth, depth - 1))
        lower = np.where(from_top, x, small) @ up + np.where(from_bottom, x, large) @ down
        upper = np.where(from_top, x, last_top) @ up + np.where(from_bottom, x, last_bottom) @ down
        return lower, upper

    def best(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
        """(number of a query, positions that can be among its best ``k``); ``floors`` are scores that k others have."""
        n = len(self.ids)
        reach = (np.abs(queries) @ np.maximum(np.abs(self.entries[:, 0]), np.abs(self.entries[:, -1])).astype(np.float64)).max(initial=0)
        kind = np.float32 if reach < 2**24 else np.float64
        # Rounding can't decide: whole numbers in this range are exact, larger ones get slack.
        slack = 0.0 if reach < EXACT else reach * 2.0**-45
        first, after = np.searchsorted(self.ids, query_ids), np.searchsorted(self.ids, query_ids, side="right")

        def own(asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Rows with a query's own id, and the query's column."""
            count = (after - first)[asked]
            column = np.repeat(np.arange(len(asked)), count)
            within = np.arange(len(column)) - np.repeat(np.cumsum(count) - count, count)
            return first[asked][column] + within, column

        live = np.arange(len(query_ids))
        for depth in depths(n):
            if n <= 4 * k or not len(live):
                break
            weights = queries[live].T.astype(kind)
            lower, upper = self.bounds(depth, np.maximum(weights, 0), np.minimum(weights, 0))
            lower[own(live)] = -np.inf
            upper[own(live)] = -np.inf
            level = np.maximum(floors[live], np.partition(lower, n - k, axis=0)[n - k])
            left = upper >= level[None, :] - 2 * slack
            few = left.sum(0) <= max(4 * k, n // 32)
            for i in np.flatnonzero(few).tolist():
                yield int(live[i]), np.flatnonzero(left[:, i])
            live = live[~few]
        # The lists of the others are read to their end: lower and upper bounds meet in the score.
        if len(live):
            scores = self.matrix.astype(kind) @ queries[live].T.astype(kind)
            scores[own(live)] = -np.inf
            level = np.maximum(floors[live], np.partition(scores, n - k, axis=0)[n - k] if n > k else -np.inf)
            left = scores >= level[None, :] - 2 * slack
            for i, q in enumerate(live.tolist()):
                yield q, np.flatnonzero(left[:, i])


def search(queries: list[tuple[int, list[int]]], k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Best ``k`` candidates of every query over the shards that a task reads."""
    by_width: dict[int, list[tuple[int, list[int]]]] = {}
    for q, v in sorted(queries):
        by_width.setdefault(len(v), []).append((q, v))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, list[tuple[int, int]]] = {}
        for batch in batches:
            for width, ids, order, matrix in batch[["width", "ids", "order", "matrix"]].itertuples(index=False):
                lists = Lists(width, ids, order, matrix)
                asked = by_width.get(width, [])
                for start in range(0, len(asked), AT_ONCE):
                    part = asked[start : start + AT_ONCE]
                    query_ids, vectors = np.array([q for q, _ in part]), np.array([v for _, v in part], np.int64)
                    floors = np.array([-best[q][-1][0] if len(best.get(q, ())) == k else -np.inf for q in query_ids.tolist()])
                    for i, left in lists.best(query_ids, vectors, floors, k):
                        q = int(query_ids[i])
                        left = left[lists.ids[left] != q]
                        scores = lists.matrix[left] @ vectors[i]
                        first = np.lexsort((lists.ids[left], -scores))[:k]
                        found = [(-int(scores[x]), int(lists.ids[left[x]])) for x in first]
                        best[q] = sorted(best.get(q, []) + found)[:k]
        hits = [(q, i, -s) for q, found in best.items() for s, i in found]
        yield pd.DataFrame(hits, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def nearest_exact(vectors: DataFrame, queries: DataFrame, k: int = 5, shard: int = SHARD, per_slice: int = SLICE) -> DataFrame:
    """The ``k`` highest integer inner products of each query: (query_id, rank, vec_id, score).

    ``vectors`` and ``queries`` have (vec_id, vector of longs); rows without an
    id or a vector take no part. All rows but those with the query's own id are
    candidates; ties go to the smaller id. A row that repeats with id and
    vector counts once; of several vectors under one query id the smallest asks.
    Vectors of another width than the query's are no candidates. An empty table
    gives an empty result. Scores must fit 64 bits.
    """
    spark = vectors.sparkSession
    usable = vectors.select("vec_id", "vector").dropna().dropDuplicates(["vec_id", "vector"])
    rows = stored(usable, "topk-vectors")
    shards = pieces(rows.count(), shard)
    lists = stored(
        rows.groupBy(F.size("vector").alias("_width"), bucket(shards, "vec_id").alias("_shard"))
        .applyInPandas(sorted_lists, LISTS),
        "topk-lists",
    )
    asked = queries.select("vec_id", "vector").dropna().groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = stored(asked, "topk-queries")
    parts = pieces(asked.count(), per_slice)
    found = None
    for part in range(parts):
        # Twice the mean at most lies in a hashed slice; its size is bounded by per_slice, not by the table.
        some = asked.filter(bucket(parts, F.lit("slice"), "vec_id") == part).collect()
        best = lists.mapInPandas(search([(r[0], r[1]) for r in some], k), HITS)
        found = stored(best, "topk-hits") if found is None else found.unionByName(stored(best, "topk-hits"))
    if found is None:
        found = spark.createDataFrame([], HITS)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op1_topk(embeddings: DataFrame) -> DataFrame:
    """Five highest inner products of every vector whose id is divisible by 50."""
    vectors = embeddings.select("vec_id", whole_numbers("embedding").alias("vector"))
    return nearest_exact(vectors, vectors.filter(col("vec_id") % 50 == 0), 5)
