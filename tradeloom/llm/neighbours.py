"""Nearest neighbours by a block matrix join with int8 product tiles.

In each grid cell rows and queries are rounded to 8-bit whole numbers with one scale. The
product of two such tiles gives squared distances between the rounded vectors, which are
whole numbers and exact in double precision; the distance of the originals differs by at
most the two rounding errors and what double precision loses in them (`RELATIVE_LOSS`). Pairs whose lower bound exceeds the k-th upper bound are dropped, the others are
recomputed from the original vectors in double precision and kept in a heap per query.
Nothing is approximated in the result: recall is 1.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm.tables import table
from tradeloom.llm.vectors import search_grid

K = 10
TILE_ROWS = 2048
#: Bound on the relative rounding error of a distance in up to some 10,000 dimensions.
RELATIVE_LOSS = 1e-11


def rounded(vectors: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """8-bit components and each vector's rounding error (Euclidean)."""
    small = np.rint(vectors / scale).astype(np.int8)
    return small, np.sqrt(((vectors - small * scale) ** 2).sum(axis=1))


def tile_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between rounded vectors: whole numbers below 2**53, so that sums
    and products of doubles are exact in any order."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)


def nearest_in_cell(query_ids, queries, row_ids, rows, k):
    """Kernel of one grid cell: at most k (query id, row id, distance) per query."""
    scale = max(float(np.abs(x).max(initial=0)) for x in (queries, rows)) / 127 or 1.0
    q8, q_off = rounded(queries, scale)
    r8, r_off = rounded(rows, scale)
    # What double precision may lose in the rounding errors and in the final distances.
    loss = 1e-13 * scale * np.sqrt(rows.shape[1])
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    for first in range(0, len(rows), TILE_ROWS):
        tile = slice(first, first + TILE_ROWS)
        about = scale * np.sqrt(tile_distances(q8, r8[tile]))
        off = q_off[:, None] + r_off[None, tile]
        off += RELATIVE_LOSS * (about + off) + loss
        own = query_ids[:, None] == row_ids[None, tile]
        upper = np.where(own, np.inf, about + off)
        lower = np.where(own, np.inf, about - off)
        if upper.shape[1] > k:
            limit = np.partition(upper, k - 1, axis=1)[:, k - 1]
        else:
            limit = np.full(len(queries), np.inf)
        for i, heap in enumerate(heaps):
            worst = min(limit[i], -heap[0][0]) if len(heap) == k else limit[i]
            at = np.flatnonzero((lower[i] <= worst) & ~own[i])
            exact = np.sqrt(((rows[tile][at] - queries[i]) ** 2).sum(axis=1))
            for distance, row_id in zip(exact.tolist(), row_ids[tile][at].tolist()):
                if len(heap) < k:
                    heapq.heappush(heap, (-distance, -row_id))
                elif (-distance, -row_id) > heap[0]:
                    heapq.heapreplace(heap, (-distance, -row_id))
    found = [(query_ids[i], -row_id, -distance) for i, heap in enumerate(heaps) for distance, row_id in heap]
    return tuple(np.array(x) for x in zip(*found)) if found else ([], [], [])


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_grid(table(spark, sf_dir, "embeddings"), nearest_in_cell, "double", best_last=False, k=K, keep_zero=False)


OP10_SQL = """
with usable as (
    select vec_id, cast(embedding as double[]) as v
    from embeddings
    where vec_id is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs as (
    select q.vec_id as query_id, c.vec_id, list_distance(q.v, c.v) as score
    from usable q join usable c on c.vec_id <> q.vec_id
    where q.vec_id % 100 = 0
), ranked as (
    select *, cast(row_number() over (partition by query_id order by score, vec_id) as integer) as rank from pairs
)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""
