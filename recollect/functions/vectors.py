"""Exact nearest vectors: blocked matrix products inside the tasks, `k` rows out per query.

Numpy is used because the built-in array functions evaluate one element at a time: measured on
200,000 vectors of width 64, half the speed, and further behind for wider vectors and more queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa

# Ranks use distances rounded here, so that equal vectors tie exactly and fall back to the id.
RANK_DECIMALS = 12
# Queries per matrix product; bounds the memory of one product to block x batch doubles.
QUERY_BLOCK = 128
# Vectors that queries without `k` answers look at together, before they can pass by most of the others.
FIRST_ROWS = 1024
# A bound on the rounding of one product of single precision, with that of its factors; a sum of `n` has `n` of them.
SINGLE_ERROR = 2.0**-23
# Numbers of the stored vectors whose exact distances are computed at once.
EXACT_VALUES = 1 << 20


class Queries(NamedTuple):
    """A bounded set of query vectors, as shipped to the tasks."""

    ids: pa.Array
    vectors: np.ndarray
    tenants: np.ndarray | None = None


class _Best:
    """The best `k` (distance, id) of each query of one block so far."""

    def __init__(self, wanted: np.ndarray, k: int):
        self.wanted, self.narrow = wanted, wanted.astype(np.float32)
        self.k = k
        self.query = np.empty(0, dtype=np.int64)
        self.distance = np.empty(0)
        self.ids = np.empty(0, dtype=object)
        self.worst = np.full(len(wanted), np.inf)

    def add(self, stored: np.ndarray, narrow: np.ndarray, allowed: np.ndarray | None, ids: pa.Array) -> None:
        """Take in some `stored` unit vectors, given in single precision too.

        A query that has its `k` computes exact distances only where those of single precision come near
        enough to its worst one for the exact one to be better; a query that has not, computes them all.
        """
        settled = np.isfinite(self.worst)
        parts = [
            part(queries, stored, narrow, None if allowed is None else allowed[queries])
            for part, queries in ((self._near, np.flatnonzero(settled)), (self._all, np.flatnonzero(~settled)))
            if len(queries)
        ]
        query, position, distance = (np.concatenate(column) for column in zip(*parts, strict=True))
        if not len(query):
            return
        kept = np.array(ids.take(pa.array(position)).to_pylist(), dtype=object)
        query = np.concatenate([self.query, query])
        distance = np.concatenate([self.distance, distance])
        ids = np.concatenate([self.ids, kept])
        order = np.lexsort((distance, query))
        if np.any((np.diff(query[order]) == 0) & (distance[order][1:] == distance[order][:-1])):
            order = np.lexsort((pd.factorize(ids, sort=True)[0], distance, query))
        query, distance, ids = query[order], distance[order], ids[order]
        starts = np.searchsorted(query, np.arange(len(self.worst)))
        rank = np.arange(len(query)) - starts[query]
        top = rank < self.k
        self.query, self.distance, self.ids = query[top], distance[top], ids[top]
        full = rank == self.k - 1
        self.worst[query[full]] = distance[full]

    def _all(self, queries: np.ndarray, stored: np.ndarray, narrow: np.ndarray, allowed: np.ndarray | None) -> tuple:
        distance = 1.0 - self.wanted[queries] @ stored.T
        distance[np.isnan(distance)] = np.inf
        if allowed is not None:
            distance[~allowed] = np.inf
        keep = np.ones(distance.shape, dtype=bool) if allowed is None else allowed.copy()
        if len(stored) > self.k:
            keep &= distance <= np.partition(distance, self.k - 1, axis=1)[:, self.k - 1 : self.k] + 10.0**-RANK_DECIMALS
        query, position = np.nonzero(keep)
        return queries[query], position, self._exact(queries[query], position, stored)

    def _near(self, queries: np.ndarray, stored: np.ndarray, narrow: np.ndarray, allowed: np.ndarray | None) -> tuple:
        error = (stored.shape[1] + 8) * SINGLE_ERROR
        near = self.narrow[queries] @ narrow.T >= (1.0 - self.worst[queries, None] - error).astype(np.float32)
        if allowed is not None:
            near &= allowed
        at = np.flatnonzero(near)
        query, position = queries[at // len(stored)], at % len(stored)
        distance = self._exact(query, position, stored)
        keep = distance <= self.worst[query]
        return query[keep], position[keep], distance[keep]

    def _exact(self, query: np.ndarray, position: np.ndarray, stored: np.ndarray) -> np.ndarray:
        """Distances of pairs, each summed alone: where a vector lies never tells equal ones apart."""
        distance = np.empty(len(query))
        at_once = max(1, EXACT_VALUES // stored.shape[1])
        for low in range(0, len(query), at_once):
            span = slice(low, low + at_once)
            pairs = self.wanted.take(query[span], axis=0), stored.take(position[span], axis=0)
            distance[span] = np.round(1.0 - np.einsum("ij,ij->i", *pairs), RANK_DECIMALS)
        distance[np.isnan(distance)] = np.inf
        return distance


def matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != len(column) * width or np.any(np.diff(column.offsets.to_numpy()) != width):
        raise ValueError(f"a stored vector does not have the query's width of {width}")
    return flat.reshape(len(column), width)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; a zero vector becomes NaN, its distance to anything is undefined."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def nearest_in(batches: Iterator[pa.RecordBatch], queries: Queries, k: int) -> Iterator[pa.RecordBatch]:
    """The best `k` of all `batches` for each query.

    A batch holds columns `id` and `vector`, and `tenant` when the queries have tenants: then a
    query sees the rows of its own tenant only. An undefined distance ranks last, as NULL.
    """
    if not len(queries.ids):
        return
    width = queries.vectors.shape[1]
    wanted = unit(queries.vectors.astype(np.float64))
    blocks = [slice(s, s + QUERY_BLOCK) for s in range(0, len(wanted), QUERY_BLOCK)]
    best = [_Best(wanted[b], k) for b in blocks]
    id_type = None
    for batch in batches:
        if not batch.num_rows:
            continue
        id_type = batch.column("id").type
        stored = unit(matrix(batch.column("vector"), width))
        narrow = stored.astype(np.float32)
        if queries.tenants is not None:
            tenants = np.array(batch.column("tenant").to_pylist(), dtype=object)
        for block, state in zip(blocks, best, strict=True):
            allowed = None
            if queries.tenants is not None:
                allowed = queries.tenants[block][:, None] == tenants[None, :]
            low = 0
            while low < len(stored):
                high = len(stored) if np.isfinite(state.worst).all() else min(low + FIRST_ROWS, len(stored))
                rows = slice(low, high)
                some = None if allowed is None else allowed[:, rows]
                state.add(stored[rows], narrow[rows], some, batch.column("id")[rows])
                low = high
    for block, state in zip(blocks, best, strict=True):
        if len(state.query):
            undefined = np.isinf(state.distance)
            yield pa.RecordBatch.from_arrays(
                [
                    queries.ids.take(pa.array(state.query + block.start)),
                    pa.array(state.ids.tolist(), type=id_type),
                    pa.array(np.where(undefined, 0.0, state.distance), mask=undefined),
                ],
                names=["query_id", "id", "distance"],
            )
