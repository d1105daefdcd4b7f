"""Suffix arrays by two-stage sorting, and adjacent common prefixes.

Suffixes smaller than their successors are sorted directly, on their first `depth` bytes.
All others are induced: scanning the array by first byte, each suffix places the one before
it, if that is larger, at the next free place of its bucket. Order beyond `depth` equal
bytes is left open, which is all that searches for repeats of that length need.
"""

from __future__ import annotations

import numpy as np

#: 2**8, 2**16, ... 2**56: a difference of two words below the k-th has 8 - k leading zero bytes.
BYTE_STEPS = np.uint64(1) << np.arange(8, 57, 8, dtype=np.uint64)


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last is not."""
    n = len(text)
    rises = np.zeros(n, np.int8)
    rises[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    # An equal byte takes the answer of the next place where bytes differ.
    known = np.where(rises != 0, np.arange(n), n)
    known[-1] = n - 1
    following = np.minimum.accumulate(known[::-1])[::-1]
    return rises[following] > 0


def needed_places(small: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The wanted suffixes and those they are induced from: for a suffix that is larger
    than the next one, all up to the next directly sorted one."""
    n = len(small)
    sorted_at = np.where(small, np.arange(n), n - 1)
    sorted_at = np.minimum.accumulate(sorted_at[::-1])[::-1]
    at = np.flatnonzero(wanted)
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, sorted_at[at] + 1, -1)
    return np.cumsum(steps[:-1]) > 0


def suffix_array(text: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Places of the wanted suffixes (default: all) in order of their first `depth` bytes."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    small = smaller_than_next(text)
    need = np.ones(n, bool) if wanted is None else needed_places(small, wanted)
    induced_place = need & ~small
    data = text.tobytes()
    direct = np.array(sorted(np.flatnonzero(small & need).tolist(), key=lambda i: data[i : i + depth]), np.int64)
    direct_byte = text[direct]
    begin = np.searchsorted(direct_byte, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if need[n - 1]:
        waiting[text[-1]].append(np.array([n - 1], np.int64))
    parts = []
    for byte in range(256):
        bucket = waiting[byte]
        fresh = np.concatenate(bucket) if bucket else np.zeros(0, np.int64)
        induced = [fresh]
        while len(fresh):
            before = fresh[fresh > 0] - 1
            fresh = before[(text[before] == byte) & induced_place[before]]
            induced.append(fresh)
        here = np.concatenate([*induced, direct[begin[byte] : begin[byte + 1]]])
        parts.append(here)
        before = here[here > 0] - 1
        before = before[(text[before] > byte) & induced_place[before]]
        if len(before):
            bytes_before = text[before]
            order = np.argsort(bytes_before, kind="stable")
            values, first = np.unique(bytes_before[order], return_index=True)
            for value, members in zip(values, np.split(before[order], first[1:])):
                waiting[value].append(members)
    order = np.concatenate(parts)
    return order if wanted is None else order[wanted[order]]


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in the array,
    up to `most`; 0 for the first."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(n, np.uint64)
    for i in range(8):
        words = (words << np.uint64(8)) | padded[i : n + i]
    length = np.zeros(len(order), np.int64)
    open_pairs = np.arange(1, len(order))
    while len(open_pairs):
        a, b = order[open_pairs] + length[open_pairs], order[open_pairs - 1] + length[open_pairs]
        inside = np.maximum(a, b) < n
        open_pairs, a, b = open_pairs[inside], a[inside], b[inside]
        differing = words[a] ^ words[b]
        some = differing != 0
        equal = np.where(some, 7 - np.searchsorted(BYTE_STEPS, differing, "right"), 8)
        length[open_pairs] += np.minimum(equal, n - np.maximum(a, b))
        open_pairs = open_pairs[~some & (length[open_pairs] < most)]
    return np.minimum(length, most)
