"""Periodic runs of words, from Lyndon arrays that the first phase of a suffix sorter yields.

A run is a longest stretch of words with smallest period q that is at least LEAST words
and two periods long.

1. Both halves of such a run hold GRAM equal words at distance q, so every word of a run
   lies in a string of GRAM words that the text repeats. Texts are cut to those stretches.
2. Baier's grouping: suffixes start in groups by their first word. From the highest group
   downwards, each suffix names the nearest earlier one of a lower group, which moves to a
   new group right above its own and is lengthened by what it was named by. At the end, a
   suffix's group is that of its longest Lyndon prefix: the Lyndon array, without the
   second phase that would order the suffixes. It is made under an order of the words and
   under its reverse, with the end of a stretch below all words in both.
3. Each run has a Lyndon root that is a longest Lyndon prefix under one of the orders. So
   every root is extended to both sides by its longest common extension (hashes of prefix
   sums modulo two primes, binary search), and long enough results are the runs.

A null or empty text has no words and no runs, as have texts shorter than a run. A very
long text takes memory in proportion to its words. Rows are judged one by one: repeated
rows and ids, null ids and columns of any other name change nothing.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.tables import table

#: Least words of a run, and the words that repeat in one at the distance of its period.
LEAST, GRAM = 12, 6
#: Words looked at together; a longer text makes a chunk of its own.
CHUNK_WORDS = 1 << 18
#: Primes and bases of the hashes.
MODULI = ((2147483647, 1481234567), (2147483629, 905137711))

#: Changes the words of a document, given its id.
Rewrite = Callable[[list[bytes], int | None], list[bytes]]


def lyndon_lengths(symbols: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon prefix of every suffix; 0 marks ends and is below all.

    `symbols` begins and ends with 0; no prefix reaches beyond the next one.
    """
    _, first, of = np.unique(symbols, return_index=True, return_inverse=True)
    groups = len(first)
    by_symbol = np.split(np.argsort(of, kind="stable"), np.cumsum(np.bincount(of))[:-1])
    members = [m.tolist() for m in by_symbol]
    group, length = of.tolist(), [1] * groups
    below, above = list(range(-1, groups - 1)), list(range(1, groups + 1))
    below.append(groups - 1)  # what is above all groups
    above.append(-1)
    members.append([])
    length.append(0)
    lower = list(range(-1, len(group) - 1))
    done = bytearray(len(group))
    current = groups - 1
    while current > 0:
        live = [i for i in members[current] if group[i] == current]
        members[current] = []
        for i in live:
            done[i] = 1
        named: dict[int, int] = {}
        for i in live:
            at = lower[i]
            if done[at]:
                passed = [i]
                while done[at]:
                    passed.append(at)
                    at = lower[at]
                for j in passed:
                    lower[j] = at
            if group[at]:
                named[at] = named.get(at, 0) + 1
        if named:
            moved: dict[tuple[int, int], list[int]] = {}
            for at, times in named.items():
                moved.setdefault((times, group[at]), []).append(at)
            for times, old in sorted(moved, reverse=True):
                new, over = len(members), above[old]
                members.append(moved[times, old])
                length.append(length[old] + times * length[current])
                below.append(old)
                above.append(over)
                above[old] = below[over] = new
                for at in members[new]:
                    group[at] = new
        current = below[current]
    return np.array(length, np.int64)[np.array(group, np.int64)]


class Extensions:
    """Longest common extensions of pairs of places of one string."""

    def __init__(self, symbols: np.ndarray):
        self.parts = []
        for prime, base in MODULI:
            power = np.ones(1, np.uint64)
            while len(power) <= len(symbols):
                power = np.concatenate([power, power * np.uint64(pow(base, len(power), prime)) % np.uint64(prime)])
            power = power[: len(symbols) + 1]
            # Symbols are spread first: neighbouring numbers would make similar sums.
            spread = (symbols.astype(np.uint64) * np.uint64(2654435761) + np.uint64(1)) % np.uint64(prime)
            sums = np.zeros(len(symbols) + 1, np.uint64)
            np.cumsum(spread * power[:-1] % np.uint64(prime), out=sums[1:])
            self.parts.append((np.uint64(prime), power, sums % np.uint64(prime)))

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether `size` symbols from a and from b (a < b) are the same."""
        same = np.ones(len(a), bool)
        for prime, power, sums in self.parts:
            left = (sums[a + size] + prime - sums[a]) % prime
            right = (sums[b + size] + prime - sums[b]) % prime
            same &= left * power[b - a] % prime == right
        return same

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, ahead: bool) -> np.ndarray:
        """How far a and b (a < b) agree, ahead from them or back to before them."""
        size = np.zeros(len(a), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step := step >> 1:
            fits = np.flatnonzero(size + step <= most)
            back = 0 if ahead else size[fits] + step
            longer = self.equal(a[fits] - back, b[fits] - back, size[fits] + step)
            size[fits[longer]] += step
        return size


def repeated_stretches(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which words lie in GRAM words in a row that their text holds at least twice."""
    n = len(words) - GRAM + 1
    inside = np.zeros(len(words), bool)
    if n < 2:
        return inside
    value = text[:n].astype(np.uint64)
    for i in range(GRAM):
        value = (value ^ words[i : i + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    at = np.flatnonzero(text[:n] == text[GRAM - 1 :])
    at = at[np.argsort(value[at], kind="stable")]
    same = value[at[1:]] == value[at[:-1]]
    again = np.zeros(len(at), bool)
    again[1:] |= same
    again[:-1] |= same
    for i in range(GRAM):
        inside[at[again] + i] = True
    return inside


def runs_of(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Rows (place of the first word, length, period) of all runs of the texts, in order.

    `words` are numbers from 1, `text` rising numbers of the texts they belong to.
    """
    places = np.flatnonzero(repeated_stretches(words, text))
    if not len(places):
        return np.zeros((0, 3), np.int64)
    new = np.ones(len(places), bool)
    new[1:] = (np.diff(places) > 1) | (text[places[1:]] != text[places[:-1]])
    # One string of all stretches, with a 0 before each and at the end.
    at = np.arange(len(places)) + np.cumsum(new)
    symbols = np.zeros(at[-1] + 2, np.int64)
    symbols[at] = words[places]
    ends = np.flatnonzero(symbols == 0)
    begin = ends[np.cumsum(new) - 1] + 1
    end = ends[np.cumsum(new)]
    extensions = Extensions(symbols)
    found = []
    for ordered in (symbols, np.where(symbols > 0, symbols.max() + 1 - symbols, 0)):
        period = lyndon_lengths(ordered)[at]
        able = np.flatnonzero(np.maximum(LEAST, 2 * period) <= end - begin)
        here, q = at[able], period[able]
        ahead = extensions.reach(here, here + q, end[able] - here - q, True)
        back = extensions.reach(here, here + q, here - begin[able], False)
        long = back + q + ahead >= np.maximum(LEAST, 2 * q)
        # The place in the whole text: stretches keep their words in order.
        found.append(np.stack([places[able][long] - back[long], (back + q + ahead)[long], q[long]], axis=1))
    found = np.concatenate(found)
    return np.unique(found[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words but those that a run holds after its first period, joined by a space."""
    if len(runs):
        steps = np.zeros(len(words) + 1, np.int64)
        np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
        np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]
    return b" ".join(words)


def find_runs(documents: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """doc_id, runs (start, length, period, by start, then period) and the collapsed text."""

    def chunk(listed: list[list[bytes]]) -> Iterator[tuple[np.ndarray, bytes]]:
        numbers: dict[bytes, int] = defaultdict(count(1).__next__)
        sizes = [len(words) for words in listed]
        ids = np.fromiter((numbers[w] for words in listed for w in words), np.int64, sum(sizes))
        found = runs_of(ids, np.repeat(np.arange(len(listed)), sizes))
        first = np.cumsum([0, *sizes])
        cuts = np.searchsorted(found[:, 0], first)
        for i, words in enumerate(listed):
            runs = found[cuts[i] : cuts[i + 1]] - [first[i], 0, 0]
            yield runs, collapsed(words, runs)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            waiting, size, first = [], 0, 0
            for row, doc_id in enumerate(ids):
                words = (texts[row].as_py() or "").encode().split()
                waiting.append(rewrite(words, doc_id) if rewrite else words)
                size += len(words)
                if size >= CHUNK_WORDS or row + 1 == len(ids):
                    runs, kept = zip(*chunk(waiting))
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(runs)), run_lists(runs), pa.array([k.decode() for k in kept], pa.string())], ["doc_id", "runs", "collapsed"])
                    waiting, size, first = [], 0, row + 1

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(find, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def run_lists(runs: tuple[np.ndarray, ...]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
    start, length, period = (pa.array(c) for c in np.concatenate(runs).T.astype(np.int64).copy())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([start, length, period], ["start", "length", "period"]))


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of the query's contract: those of one id in ten repeat from some word on.

    A null id repeats nothing.
    """
    if doc_id is None or not words:
        return words
    g, rest = divmod(zlib.crc32(b"%d" % doc_id), 10)
    if rest:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def digest_runs(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one and the digests of the contract."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    line: Callable[[Column], Column] = lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_runs(find_runs(table(spark, sf_dir, "documents"), planted))
