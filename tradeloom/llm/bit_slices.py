"""Exact top-k by inner product over a bit-sliced index.

Components become floor(1024 * x). In each grid cell the leading bits of every component
are stored as slices, one bitmap over the rows per bit. The product of a query with all
rows is added up slice by slice with bitmap adders, for all queries of the cell at once;
the rows of the k largest coarse sums are selected from the most significant slice down.
The dropped low bits have a bounded effect: all rows whose coarse sum lies within that
bound of the k-th are resolved with exact integer products.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm.tables import table
from tradeloom.llm.vectors import search_grid

SCALE, K = 1024, 10
#: Leading magnitude bits kept of rows and queries.
KEPT_BITS = 6
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def packed(flags: np.ndarray) -> np.ndarray:
    """Bitmaps over the last axis as 64-bit words."""
    bits = np.packbits(flags, axis=-1, bitorder="little")
    short = -bits.shape[-1] % 8
    bits = np.pad(bits, [(0, 0)] * (bits.ndim - 1) + [(0, short)])
    return np.ascontiguousarray(bits).view(np.uint64)


def slices_of(values: np.ndarray) -> np.ndarray:
    """Bitmaps of a matrix of whole numbers >= 0 (rows x columns): columns x bits x words."""
    bits = max(1, int(values.max(initial=0)).bit_length())
    return np.stack([packed((values.T >> b) & 1 == 1) for b in range(bits)], axis=1)


def add_into(total: list[np.ndarray], number: list[np.ndarray], at: int = 0) -> None:
    """Adds a bit-sliced number, shifted left by `at`, to a bit-sliced total."""
    while len(total) < at:
        total.append(np.zeros_like(number[0]))
    carry = None
    for i, bits in enumerate(number):
        place = at + i
        if place == len(total):
            total.append(bits if carry is None else bits ^ carry)
            carry = None if carry is None else bits & carry
            continue
        old = total[place]
        half = old ^ bits
        if carry is None:
            total[place], carry = half, old & bits
        else:
            total[place], carry = half ^ carry, (old & bits) | (half & carry)
    place = at + len(number)
    while carry is not None and carry.any():
        if place == len(total):
            total.append(carry)
            return
        total[place], carry = total[place] ^ carry, total[place] & carry
        place += 1


def coarse_sums(rows: np.ndarray, queries: np.ndarray) -> list[np.ndarray]:
    """Slices, each queries x words, of the products of numbers >= 0 added up over columns."""
    index = slices_of(rows)
    total: list[np.ndarray] = []
    for b in range(max(1, int(queries.max(initial=0)).bit_length())):
        chosen = np.where((queries >> b) & 1 == 1, ALL, np.uint64(0))
        part: list[np.ndarray] = []
        for d in range(rows.shape[1]):
            if chosen[:, d].any():
                add_into(part, [chosen[:, d, None] & index[d, i] for i in range(index.shape[1])])
        if part:
            add_into(total, part, b)
    return total or [np.zeros((len(queries), index.shape[2]), np.uint64)]


def subtract(total: list[np.ndarray], number: list[np.ndarray]) -> list[np.ndarray]:
    """total - number + 2 ** bits, so that the result is never negative."""
    bits = max(len(total), len(number))
    zero = np.zeros_like(total[0])
    borrow, out = zero, []
    for i in range(bits):
        a = total[i] if i < len(total) else zero
        b = number[i] if i < len(number) else zero
        out.append(a ^ b ^ borrow)
        borrow = (~a & (b | borrow)) | (b & borrow)
    return [*out, ~borrow]


def largest(sums: list[np.ndarray], open_rows: np.ndarray, k: int) -> np.ndarray:
    """For each query the k-th largest sum of its open rows (0 if there are fewer)."""
    sure, level = np.zeros_like(open_rows), open_rows.copy()
    value = np.zeros(len(open_rows), np.int64)
    for i in range(len(sums) - 1, -1, -1):
        upper = level & sums[i]
        enough = np.bitwise_count(sure | upper).sum(axis=1) >= k
        sure = np.where(enough[:, None], sure, sure | upper)
        level = np.where(enough[:, None], upper, level & ~sums[i])
        value += enough.astype(np.int64) << i
    return value


def at_least(sums: list[np.ndarray], bound: np.ndarray, open_rows: np.ndarray) -> np.ndarray:
    """Bitmaps of the open rows whose sum reaches each query's bound."""
    more, equal = np.zeros_like(open_rows), open_rows.copy()
    for i in range(len(sums) - 1, -1, -1):
        one = ((bound >> i) & 1 == 1)[:, None]
        more = np.where(one, more, more | (equal & sums[i]))
        equal = np.where(one, equal & sums[i], equal & ~sums[i])
    return more | equal


def bit_sliced_top(query_ids, queries, row_ids, rows, k):
    """Kernel of one grid cell: at most k (query id, row id, exact score) per query."""
    v, q = np.floor(SCALE * rows).astype(np.int64), np.floor(SCALE * queries).astype(np.int64)
    shift = lambda x: max(0, int(np.abs(x).max(initial=0)).bit_length() - KEPT_BITS)
    s, t = shift(v), shift(q)
    u, p = v >> s, (q + (1 << t >> 1)) >> t
    low = u.min(axis=0)
    least = int(p.min())
    # sum(p * u) = sum((p - least) * (u - low)) + least * sum(u - low) + sum(p * low)
    sums = coarse_sums(u - low, p - least)
    if least:
        rest = coarse_sums(u - low, np.full((1, u.shape[1]), abs(least)))
        rest = [np.broadcast_to(x, sums[0].shape) for x in rest]
        if least < 0:
            sums = subtract(sums, rest)
        else:
            add_into(sums, rest)
    # v = 2**s * u + r and q = 2**t * p + a: what the coarse sum leaves out, at most.
    middle = ((1 << s) - 1) / 2
    off_rows = np.sqrt((((v - (u << s)) - middle) ** 2).sum(axis=1).max())
    off_queries = np.sqrt(((q - (p << t)) ** 2).sum(axis=1))
    radius = np.sqrt((q**2).sum(axis=1)) * off_rows + (1 << s) * off_queries * np.sqrt((u**2).sum(axis=1).max())
    slack = np.ceil(2 * radius / (1 << (s + t)) + 1).astype(np.int64)
    open_rows = packed(query_ids[:, None] != row_ids[None, :])
    bound = np.maximum(0, largest(sums, open_rows, k) - slack)
    wanted = np.unpackbits(at_least(sums, bound, open_rows).view(np.uint8), axis=1, bitorder="little")[:, : len(rows)]
    out = ([], [], [])
    for i, flags in enumerate(wanted):
        at = np.flatnonzero(flags)
        score = v[at] @ q[i]
        best = np.lexsort((row_ids[at], -score))[:k]
        out[0].append(np.full(len(best), query_ids[i]))
        out[1].append(row_ids[at][best])
        out[2].append(score[best])
    return tuple(np.concatenate(x) for x in out)


def op4_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_grid(table(spark, sf_dir, "embeddings"), bit_sliced_top, "long", best_last=True, k=K, keep_zero=True)


OP4_SQL = """
with usable as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as double)) as v
    from embeddings
    where vec_id is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
), pairs as (
    select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
    from usable q join usable c on c.vec_id <> q.vec_id
    where q.vec_id % 100 = 0
), ranked as (
    select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from pairs
)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""
