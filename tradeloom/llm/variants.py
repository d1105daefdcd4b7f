"""Spelling variants of the words of a corpus, by search schemes over bidirectional FM-indexes.

1. Words are counted by tasks, then over all documents; the vocabulary are those of LEAST
   letters that occur twice or more.
2. Of two words one edit apart, one half of either is in the other unchanged: the first half
   as its beginning or the second as its end. So a word is dealt to a cell by each beginning
   and each end that a word of about its length could have as its half. A half that very many
   words have is dealt over a grid of cells, each holding some of them against some.
3. A cell indexes its words, delimited as `^word$`, by the suffix ranks of the text and of the
   reversed text, so that a pattern's interval can be extended to either side. For each word
   the unchanged half is matched exactly from the middle outwards, delimiter included; then
   the interval is extended across the other half, with one edit. What the second scheme
   finds is kept only if the first cannot have found it, so every pair is found once.
4. Per word, cells return the number of near words and the best one. Chains of forms end
   after few steps, as counts grow tenfold with each; they are followed by doubling.

Letters are those of the Latin-1 range; other code points end a word. Null and empty texts
have no words; a word of a null id is taken as written. Very long texts take memory in
proportion to their words, very long words are words like others. Repeated rows count as
often as they occur; ties go to the smaller word in code-point order. Columns of other names
play no part, and an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.tables import table, written

#: Least length and count of a word, and how many times commoner its form has to be.
LEAST, OFTEN, TIMES = 7, 2, 10
#: Different words a task counts at once before it hands them on.
HELD_WORDS = 300_000
#: Letters of a cell's words, and words searched at once.
CELL_LETTERS, SEARCHED = 1 << 20, 4096
LETTERS = bytes(c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: Ends of a word in the index; both are smaller than all letters.
END, BEGIN = 0, 1

#: Changes a lower-cased word (Latin-1 bytes), given the id of its document.
Rewrite = Callable[[bytes, int], bytes]


def counted_words(documents: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """word and n of all words long enough, over all documents."""

    def listed(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                # One byte per code point; those beyond Latin-1 become a question mark.
                data = (text.as_py() or "").encode("latin-1", "replace")
                for word, n in Counter(data.lower().translate(LETTERS).split()).items():
                    if rewrite and doc_id is not None and len(word) >= LEAST:
                        word = rewrite(word, doc_id)
                    if len(word) >= LEAST:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield listed(held)
                    held.clear()
        yield listed(held)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Wavelet:
    """Symbols of a text in an order of its suffixes; intervals of it are narrowed by a symbol."""

    def __init__(self, symbols: np.ndarray, bits: int):
        counts = np.bincount(symbols, minlength=1 << bits)
        self.levels, row = [], symbols
        for bit in range(bits - 1, -1, -1):
            low = (row >> bit) & 1 == 0
            zeros = np.zeros(len(row) + 1, np.int32)
            np.cumsum(low, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            row = np.concatenate([row[low], row[~low]])
        # From a symbol's place behind the last level to its place among sorted symbols.
        first = np.zeros(1 << bits, np.int64)
        new = np.flatnonzero(np.diff(row, prepend=-1))
        first[row[new]] = new
        self.shift = np.cumsum(counts) - counts - first

    def narrow(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The interval of the suffixes in [low, high) with the symbol before them, and how
        many of those have a smaller one."""
        smaller = np.zeros(len(low), np.int64)
        for bit, zeros, size in self.levels:
            one = (symbol >> bit) & 1 == 1
            zero_low, zero_high = zeros[low].astype(np.int64), zeros[high].astype(np.int64)
            smaller += np.where(one, zero_high - zero_low, 0)
            low = np.where(one, size + low - zero_low, zero_low)
            high = np.where(one, size + high - zero_high, zero_high)
        return low + self.shift[symbol], high + self.shift[symbol], smaller


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order, each read to the end of its string; ties by place.

    Ranks of the first 8 symbols, then of twice as many, until nothing more is told apart.
    """
    n = len(text)
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)
    padded = np.concatenate([text, np.zeros(8, text.dtype)]).astype(np.uint64)
    packed = np.zeros(n, np.uint64)
    for i in range(8):
        packed = (packed << np.uint64(8)) | np.where(left > i, padded[i : n + i], np.uint64(0))
    values, rank = np.unique(packed, return_inverse=True)
    told, width = len(values), 8
    while width < left.max(initial=0):
        next_rank = np.zeros(n, np.int64)
        inside = np.flatnonzero(left > width)
        next_rank[inside] = rank[inside + width] + 1
        values, rank = np.unique(rank * (told + 1) + next_rank, return_inverse=True)
        if len(values) == told:
            break
        told, width = len(values), 2 * width
    return np.argsort(rank, kind="stable")


class BidirectionalIndex:
    """Delimited words, with the suffix ranks of their text and of the reversed text.

    A pattern's state is (first rank, first rank of the reversed pattern, occurrences).
    """

    def __init__(self, words: list[bytes]):
        """`words` are sorted and different."""
        data = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.array([len(w) for w in words], np.int64)
        alphabet = np.unique(data)
        self.code = np.full(256, -1, np.int64)
        self.code[alphabet] = np.arange(len(alphabet)) + 2
        self.symbols = len(alphabet) + 2
        bits = max(1, int(self.symbols - 1).bit_length())
        ends = np.cumsum(sizes + 2)
        text = np.full(ends[-1], -1, np.int64)
        text[ends - 1], text[ends - sizes - 2] = END, BEGIN
        text[text < 0] = self.code[data]
        # Each word reversed in its place.
        back = np.repeat(2 * ends - sizes - 3, sizes + 2) - np.arange(len(text))
        self.before = []
        for one in (text, text[back]):
            # What precedes a string's first symbol is never asked for.
            order, first = suffix_order(one, ends), np.zeros(len(one), bool)
            first[ends - sizes - 2] = True
            self.before.append(np.where(first[order], END, one[order - 1]))
        self.waves = [Wavelet(before, bits) for before in self.before]
        self.size, self.first_word = len(text), len(words)

    def extend(self, state: np.ndarray, symbol: np.ndarray, ahead: int) -> np.ndarray:
        """The states (rows) of the patterns with one more symbol behind (ahead=1) or before."""
        own = state[ahead]
        low, high, smaller = self.waves[ahead].narrow(own, own + state[2], symbol)
        other = state[1 - ahead] + smaller
        return np.stack([other, low, high - low] if ahead else [low, other, high - low])

    def next_symbols(self, state: np.ndarray, ahead: int) -> tuple[np.ndarray, np.ndarray]:
        """(number of the state, letter) of each letter that may follow a pattern."""
        small = np.flatnonzero(state[2] <= self.symbols)
        large = np.flatnonzero(state[2] > self.symbols)
        sizes = state[2, small]
        number = np.repeat(small, sizes)
        at = np.repeat(state[ahead, small] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        pairs = np.unique(number * self.symbols + self.before[ahead][at])
        every = (large[:, None] * self.symbols + np.arange(self.symbols)[None, :]).ravel()
        pairs = np.concatenate([pairs, every])
        letter = pairs % self.symbols
        return (pairs // self.symbols)[letter > BEGIN], letter[letter > BEGIN]

    def one_edit(self, exact: list[np.ndarray], rest: list[np.ndarray], ahead: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the query, number of the word) that differ by one edit in `rest`.

        `exact` is matched against the direction of `rest`; both hold symbols from the middle
        outwards, -1 for a letter no word has, and end with a delimiter.
        """
        q = np.arange(len(exact))
        state = np.tile(np.array([[0], [0], [self.size]]), len(exact))
        flat, first, size = flattened(exact)
        for step in range(size.max(initial=0)):
            symbol = flat[first[q] + np.minimum(step, size[q] - 1)]
            more = np.flatnonzero((step < size[q]) & (symbol >= 0))
            state[:, more] = self.extend(state[:, more], symbol[more], 1 - ahead)
            kept = ((step >= size[q]) | (symbol >= 0)) & (state[2] > 0)
            q, state = q[kept], state[:, kept]
        flat, first, size = flattened(rest)
        place, edited = np.zeros(len(q), np.int64), np.zeros(len(q), bool)
        found: list[np.ndarray] = [np.zeros((2, 0), np.int64)]
        while len(q):
            symbol = flat[first[q] + place]
            last = place + 1 == size[q]
            branches = []
            goes_on = np.flatnonzero((symbol >= 0) & ~(last & ~edited))
            grown = self.extend(state[:, goes_on], symbol[goes_on], ahead)
            branches.append((q[goes_on], place[goes_on] + 1, edited[goes_on], grown))
            open_at = np.flatnonzero(~edited)
            number, letter = self.next_symbols(state[:, open_at], ahead)
            number = open_at[number]
            other = letter != symbol[number]
            number, letter = number[other], letter[other]
            grown = self.extend(state[:, number], letter, ahead)
            yes = np.ones(len(number), bool)
            branches.append((q[number], place[number], yes, grown))  # one letter more
            inner = ~last[number]
            branches.append((q[number[inner]], place[number[inner]] + 1, yes[inner], grown[:, inner]))
            skip = np.flatnonzero(~edited & ~last)
            branches.append((q[skip], place[skip] + 1, np.ones(len(skip), bool), state[:, skip]))
            q, place, edited = (np.concatenate([b[i] for b in branches]) for i in range(3))
            state = np.concatenate([b[3] for b in branches], axis=1)
            alive = state[2] > 0
            done = alive & (place == size[q])
            # The pattern is now a whole delimited word; its rank counts from the first BEGIN.
            found.append(np.stack([q[done], state[0, done] - self.first_word]))
            alive &= ~done
            q, place, edited, state = q[alive], place[alive], edited[alive], state[:, alive]
        pairs = np.concatenate(found, axis=1)
        pairs = np.unique(pairs[0] * self.first_word + pairs[1])
        return pairs // self.first_word, pairs % self.first_word


def flattened(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(p) for p in parts], np.int64)
    return np.concatenate(parts), np.cumsum(size) - size, size


def near_in_cell(indexed: list[bytes], counts: np.ndarray, asked: list[bytes], ending: bool) -> Iterator[tuple[int, int, int]]:
    """(number of the asked word, its near words, the best of them) where there are any.

    `indexed` is sorted. Near words share the first half of the asked one or, with `ending`,
    its second half, but not its first.
    """
    index = BidirectionalIndex(indexed)
    for begin in range(0, len(asked), SEARCHED):
        part = asked[begin : begin + SEARCHED]
        heads, tails = [], []
        for word in part:
            symbols, half = index.code[np.frombuffer(word, np.uint8)], len(word) // 2
            heads.append(np.append(symbols[:half][::-1], BEGIN))
            tails.append(np.append(symbols[half:], END))
        q, w = index.one_edit(tails, heads, 0) if ending else index.one_edit(heads, tails, 1)
        if ending:
            other = [not indexed[j].startswith(part[i][: len(part[i]) // 2]) for i, j in zip(q.tolist(), w.tolist())]
            q, w = q[other], w[other]
        order = np.lexsort((w, -counts[w], q))
        q, w = q[order], w[order]
        who, first, near = np.unique(q, return_index=True, return_counts=True)
        yield from zip((begin + who).tolist(), near.tolist(), w[first].tolist())


def halves(words: DataFrame) -> DataFrame:
    """word, n, ending, half and whether the half is the word's own, for each half by which a
    word of its length, or one letter more or less, may find it."""
    size = F.length("word")
    first = [F.floor((size + d) / 2).cast("int") for d in (-1, 0, 1)]
    rest = [F.ceil((size + d) / 2).cast("int") for d in (-1, 0, 1)]

    def keyed(lengths, ending: bool):
        part = (lambda k: F.right(F.col("word"), k)) if ending else (lambda k: F.left(F.col("word"), k))
        make = lambda k: F.struct(F.lit(ending).alias("ending"), part(k).alias("half"), (k == lengths[1]).alias("asks"))
        return F.transform(F.array_distinct(F.array(*lengths)), make)

    return words.select("word", "n", F.inline(F.concat(keyed(first, False), keyed(rest, True))))


def cells(words: DataFrame) -> DataFrame:
    """The words dealt to cells: ending, block, i, j, word, n, indexed and asked."""
    rows = halves(words)
    sizes = rows.groupBy("ending", "half").agg(F.count("*").alias("members"), F.sum(F.length("word") + 2).alias("letters"))
    sizes = written(sizes.where("members > 1"), "halves")
    total = sizes.agg(F.coalesce(F.sum("letters"), F.lit(0))).first()[0]
    blocks = total // CELL_LETTERS + 1
    parts = F.ceil(F.col("letters") / CELL_LETTERS).cast("int")
    block = F.xxhash64("half")
    # Halves of usual size share a block; one beyond that has a grid of cells of its own.
    sizes = sizes.select("ending", "half", parts.alias("parts"), F.when(parts > 1, block).otherwise(F.pmod(block, F.lit(blocks))).alias("block"))
    rows = rows.join(sizes, ["ending", "half"])
    own = F.pmod(F.xxhash64("word", F.lit(5)), F.col("parts")).cast("int")
    place = lambda i, j, indexed, asked: F.struct(i.alias("i"), j.alias("j"), indexed.alias("indexed"), asked.alias("asked"))
    no, yes, every = F.lit(False), F.lit(True), F.sequence(F.lit(0), F.col("parts") - 1)
    spread = F.concat(
        F.transform(every, lambda t: place(own, t, yes, no)),
        F.when(F.col("asks"), F.transform(every, lambda t: place(t, own, no, yes))).otherwise(F.array()),
    )
    alone = F.array(place(F.lit(0), F.lit(0), yes, F.col("asks")))
    return rows.select("ending", "block", "word", "n", F.inline(F.when(F.col("parts") > 1, spread).otherwise(alone)))


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, and n and word of the best near word, for words that have any."""

    def search(rows: pa.Table) -> pa.Table:
        names = [w.encode("latin-1") for w in rows.column("word").to_pylist()]
        counts = rows.column("n").to_pylist()
        held = rows.column("indexed").to_pylist()
        # A word may be here by two of its halves.
        index = {w: n for w, n, here in zip(names, counts, held) if here}
        asked = sorted({w for w, asks in zip(names, rows.column("asked").to_pylist()) if asks})
        known = sorted(index)
        found = []
        if known and asked:
            found = list(near_in_cell(known, np.array([index[w] for w in known], np.int64), asked, rows.column("ending")[0].as_py()))
        columns = list(zip(*((asked[i].decode("latin-1"), n, index[known[j]], known[j].decode("latin-1")) for i, n, j in found))) or [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["word", "n_near", "best_n", "best"])

    found = cells(words).groupBy("ending", "block", "i", "j").applyInArrow(search, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    rows = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
    return rows.select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """word and root of the words with a form; no count exceeds `most`."""
    steps = max(1, int(math.log10(max(most, 1))) + 1)
    links = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(steps)))):
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = written(links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return links


def spelling_variants(documents: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """word, form, root, n, n_near and form_n of the whole vocabulary."""
    words = written(counted_words(documents, rewrite).where(F.col("n") >= OFTEN), "words")
    near = written(near_words(words), "near")
    much = F.col("best_n") >= TIMES * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(much, F.col("best")).alias("form"),
        F.when(much, F.col("best_n")).alias("form_n"),
    )
    rows = written(rows, "forms")
    ends = roots(rows.where("form is not null"), words.agg(F.max("n")).first()[0] or 0)
    root = F.coalesce("root", "word").alias("root")
    return rows.join(ends, "word", "left").select("word", "form", root, "n", "n_near", "form_n")


def lost_letter(word: bytes, doc_id: int) -> bytes:
    """The word of the query's contract: one letter is missing where 31 divides its checksum."""
    known = word if word.isascii() else word.decode("latin-1").encode()
    h = zlib.crc32(b"%d:%b" % (doc_id, known))
    if h % 31:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), lost_letter)
