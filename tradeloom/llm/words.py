"""Words, hashes and changes of Arrow text columns, computed for many texts at once.

A chunk is a run of whole texts whose UTF-8 bytes lie behind each other in one numpy
array. Word hashes come from prefix sums of a polynomial in one odd 64-bit base, so that
the hash of any byte range takes two look-ups, and are finished by a bijective mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text makes a chunk of its own.
CHUNK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: Byte classes: 0 splits words, 1 letters, digits and all bytes beyond ASCII, 2 other signs.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
CLASSES = np.full(256, 2, np.uint8)
CLASSES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
CLASSES[WHITE] = 0
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each text begins; null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    bounds = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    size = int(bounds[-1])
    whole = np.frombuffer(data, np.uint8, size) if size else np.zeros(0, np.uint8)
    return whole[bounds[0] :], bounds - bounds[0]


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds) of runs of whole texts, each of `most` bytes or one text."""
    data, bounds = text_bytes(column)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RangeHash:
    """Hashes of byte ranges of one chunk."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        self._grow(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._powers[: len(data)], out=self.sums[1:])

    @classmethod
    def _grow(cls, size: int) -> None:
        if len(cls._powers) < size:
            size = 1 << (size - 1).bit_length()
            for name, factor in (("_powers", BASE), ("_inverses", INVERSE)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self._inverses[starts])


def token_bounds(data: np.ndarray, bounds: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of maximal runs of one non-zero class within a text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    kinds = classes[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kinds[1:] != kinds[:-1]
    edge[bounds] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    kept = kinds[starts] != 0
    starts, ends = starts[kept], ends[kept]
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def replace_texts(batch: pa.RecordBatch, new: dict[int, str]) -> pa.RecordBatch:
    """The batch with new texts in some rows, n_chars following where it is a column."""
    if not new:
        return batch
    flags = np.zeros(batch.num_rows, bool)
    flags[list(new)] = True
    rows = sorted(new)
    columns = {"text": [new[r] for r in rows], "n_chars": [len(new[r]) for r in rows]}
    for name, values in columns.items():
        if name in batch.schema.names:
            at = batch.schema.get_field_index(name)
            old = batch.column(at)
            batch = batch.set_column(at, batch.schema.field(at), pc.replace_with_mask(old, pa.array(flags), pa.array(values, old.type)))
    return batch
