"""The arithmetic of one similarity task: a matrix product and its best entries."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle

# Tasks receive these functions by value, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Scores held at a time, and how far a score of a matrix product may be off.
MAX_CELLS = 4_000_000
CLOSE = 1e-9


def unit_rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of an Arrow list column as a float64 matrix of unit rows; a missing entry is 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = np.nan_to_num(flat).reshape(len(column), -1)
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1.0)


def as_numpy(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


def best(hits: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` highest scores of each query, smaller ids first among equals."""
    ranked = hits.sort_values(["query_id", "score", "id"], ascending=[True, False, True])
    return ranked.groupby("query_id", sort=False).head(k)


def products(rows: np.ndarray, queries: np.ndarray, row: np.ndarray, query: np.ndarray, step: int = 100_000) -> np.ndarray:
    """The products of some pairs, each summed by itself."""
    parts = [(rows[row[i : i + step]] * queries[query[i : i + step]]).sum(axis=1) for i in range(0, len(row), step)]
    return np.concatenate([np.empty(0), *parts])


def nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best rows of each query.

    Rows go in order of their ids and in slices that bound the score matrix.
    A slice gives exactly ``k`` rows per query however many scores are equal.
    The last bits of a matrix product follow from where a row stands in it, so
    scores about as high as the ``k``-th are worked out again, one by one:
    equal rows then have equal scores.
    """
    order = np.argsort(ids, kind="stable")
    step = max(k, MAX_CELLS // max(1, len(query_ids)))
    found = []
    for start in range(0, len(order), step):
        part = order[start : start + step]
        scores = rows[part] @ queries.T
        if len(part) > k:
            level = np.partition(scores, len(part) - k, axis=0)[len(part) - k]
            near = np.nonzero(scores >= level - CLOSE)
        else:
            near = tuple(a.ravel() for a in np.indices(scores.shape))
        scores = np.full(scores.shape, -np.inf)
        scores[near] = products(rows[part], queries, *near)
        if len(part) > k:
            level = np.partition(scores, len(part) - k, axis=0)[len(part) - k]
            above = scores > level
            equal = scores == level
            room = k - above.sum(axis=0)
            row, query = np.nonzero(above | (equal & (np.cumsum(equal, axis=0) <= room)))
        else:
            row, query = near
        found.append(pd.DataFrame({"query_id": query_ids[query], "id": ids[part][row], "score": scores[row, query]}))
    return best(pd.concat(found), k)
