"""Packing of tokenised documents into sequences by lexical retrieval.

A document is its ids and one closing id. Whole windows are cut off its front. The rests
are sorted by their words and dealt over shards in that order: the sort key is a min-hash
of the ids with the largest BM25 weights in a rest, with document frequencies over all
rests, so that rests that share rare words come to lie together; doc_id, start, checksum
and place order the rests of one key, which may so fill many shards. Each shard holds a BM25 inverted index
over the ids of its rests. The longest unused rest seeds a window; unused neighbours that
fit fill it in order of their BM25 score, and the best neighbour that does not fit is cut
to fill it up. What is left at the end of a shard is cut into sequences of powers of two,
so that nothing is padded at all.

A null text is empty and has the closing id alone. Repeated rows are packed each on their
own. Equal scores go to the rest that comes first (by length, then id and start). Ids are
those of the vocabulary file, found by a compiled encoder over the same merges, which gets
a word that comes again within some megabytes of text once.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.bpe import PATTERN, VOCABULARY, Bpe
from tradeloom.llm.tables import table, written
from tradeloom.llm.words import mix, text_chunks

WINDOW, CLOSING = 2048, 1
#: Rests per shard, shards per task; BM25 saturation and length weight.
SHARD_ROWS, TASK_SHARDS = 512, 8
#: Ids of a rest that its key is made from.
KEY_IDS = 16
K1, B = 1.2, 0.75
#: Bytes of text whose words are told apart at once.
WORDS_OF = 1 << 22
#: Signs that the pattern takes for white space (and some more).
SPACE = r"\t-\r\x{1c}- \x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"


class Encoder:
    """Ids of texts with special texts as their own ids."""

    def __init__(self, vocabulary: str):
        bpe = Bpe(vocabulary)
        special = set(bpe.special.values())
        ranks = {text: i for i, text in enumerate(bpe.bytes_of) if text and i not in special}
        self.table = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=bpe.special)
        self.sizes = np.array([len(text) for text in bpe.bytes_of])
        #: A space before white space or the end; a special text; any space if special texts have one.
        whole = [rf" ([{SPACE}]|\z)", *map(regex.escape, bpe.special), *(" " for text in bpe.special if " " in text)]
        self.whole = "|".join(whole)

    def __call__(self, text: str) -> np.ndarray:
        return self.table.encode_to_numpy(text, allowed_special="all")

    def many(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, null being empty; words that come again are encoded once.

        The pattern begins a word at every space that no white space follows, whatever
        stands around, so texts are cut there. Texts with other spaces or special texts
        are encoded whole.
        """
        if not len(texts):
            return []
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(texts, self.whole)
        lists = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        begin, words = lists.offsets.to_numpy(), lists.flatten()
        heads = np.zeros(len(words), bool)
        heads[begin[:-1]] = True
        following = words.filter(pa.array(~heads)).dictionary_encode()
        ids, ends = self._distinct(following.dictionary)
        apart = [self(text) for text in pc.if_else(whole, texts, words.filter(pa.array(heads))).to_pylist()]
        size = np.concatenate([np.diff(ends, prepend=0), [len(x) for x in apart]]).astype(np.int64)
        ids, at = np.concatenate([ids, *apart]), np.cumsum(size) - size
        word = np.empty(len(words), np.int64)
        word[heads] = len(ends) + np.arange(len(texts))
        word[~heads] = following.indices.to_numpy()
        size = size[word]
        end = np.cumsum(size)
        found = ids[np.arange(end[-1]) + np.repeat(at[word] - (end - size), size)]
        return np.split(found, end[begin[1:-1] - 1])

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words with a space before each, and where each word's ids end."""
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        [joined] = pc.binary_join(pa.LargeListArray.from_arrays([0, len(words)], words), pa.scalar(" ", words.type)).to_pylist()
        ids = self.table.encode_to_numpy(f" {joined}", allowed_special=set(), disallowed_special=())
        bytes_end = np.cumsum(pc.binary_length(words).to_numpy() + 1)
        return ids, np.searchsorted(np.cumsum(self.sizes[ids]), bytes_end) + 1


@functools.cache
def encoder_of(vocabulary: str) -> Encoder:
    """One encoder per worker process and vocabulary file, as tables take time to build."""
    return Encoder(vocabulary)


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
CUT_SCHEMA = f"{PIECE}, ids binary, place long"
KEYS = ["key_a", "key_b", "key_c"]
PACKED_SCHEMA = f"{PIECE}, sequence_id long, offset long"


def cut_documents(documents: DataFrame, vocabulary: str) -> DataFrame:
    """Whole windows (without their ids) and rests (with ids) of all documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(vocabulary)
        for batch in (b.slice(first, len(bounds) - 1) for b in batches for first, _, bounds in text_chunks(b.column("text"), WORDS_OF)):
            out: list[list] = [[] for _ in range(7)]
            rows = (batch.column(c).to_pylist() for c in ("doc_id", "place"))
            for doc_id, place, found in zip(*rows, encode.many(batch.column("text"))):
                ids = np.append(found, np.uint32(CLOSING)).astype("<u4")
                for start in range(0, len(ids), WINDOW):
                    piece = ids[start : start + WINDOW].tobytes()
                    whole = len(piece) == 4 * WINDOW
                    for column, value in zip(out, (doc_id, start, len(piece) // 4, zlib.crc32(piece), len(ids), None if whole else piece, place)):
                        column.append(value)
            types = [pa.int64()] * 5 + [pa.binary(), pa.int64()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "place"]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names)

    place = F.monotonically_increasing_id()
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), place.alias("place"))
    return rows.mapInArrow(cut, CUT_SCHEMA)


def distinct_ids(ids: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in no order, and how often each occurs; `last` is room for any id."""
    last[ids] = np.arange(len(ids))
    counts = np.bincount(last[ids])
    places = np.flatnonzero(counts)
    return ids[places], counts[places]


def id_frequencies(pieces: DataFrame) -> tuple[np.ndarray, int, float]:
    """Number of rests with each id, and number and mean length of all rests."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, last = np.zeros(1, np.int64), np.zeros(1, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                ids = np.frombuffer(ids.as_py(), "<u4")
                if (more := int(ids.max()) + 1 - len(texts)) > 0:
                    texts, last = (np.append(x, np.zeros(more + len(x), np.int64)) for x in (texts, last))
                texts[distinct_ids(ids, last)[0]] += 1
        some = np.flatnonzero(texts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(texts[some])], ["id", "texts"])

    rests = pieces.where("ids is not null")
    found = rests.select("ids").mapInArrow(count, "id long, texts long").groupBy("id").agg(F.sum("texts").alias("texts")).toPandas()
    texts = np.zeros(int(found["id"].max() if len(found) else 0) + 1, np.int64)
    texts[found["id"].to_numpy(np.int64)] = found["texts"]
    rows, mean = rests.agg(F.count("*"), F.coalesce(F.avg("length"), F.lit(1.0))).first()
    return texts, rows, mean


def lexical_key(ids: np.ndarray, idf: np.ndarray, mean: float, hashes: np.ndarray, last: np.ndarray) -> list[int]:
    """The least hashes of the KEY_IDS ids of the largest BM25 weight that others share;
    of equal weights the smaller id counts."""
    found, counts = distinct_ids(ids, last)
    weight = idf[found] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * len(ids) / mean))
    if len(found) > KEY_IDS:
        some = weight >= np.partition(weight, -KEY_IDS)[-KEY_IDS]
        found, weight = found[some], weight[some]
    best = np.lexsort((found, -weight))[:KEY_IDS]
    best = found[best[weight[best] > 0]]
    least = np.sort(hashes[best])[: len(KEYS)].tolist()
    return least + [0] * (len(KEYS) - len(least))


def with_keys(pieces: DataFrame, idf: np.ndarray, mean: float) -> DataFrame:
    """The pieces with the keys of their ids, or, for whole windows, of their checksums."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = mix(np.arange(len(idf), dtype=np.uint64) + np.uint64(7)).view(np.int64)
        last = np.zeros(len(idf), np.int64)
        for batch in batches:
            keys = []
            spread = mix(batch.column("ids_crc32").to_numpy()).view(np.int64).tolist()
            for ids, own in zip(batch.column("ids").to_pylist(), spread):
                keys.append([own] * len(KEYS) if ids is None else lexical_key(np.frombuffer(ids, "<u4"), idf, mean, hashes, last))
            columns = [pa.array([k[i] for k in keys], pa.int64()) for i in range(len(KEYS))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *KEYS])

    return pieces.mapInArrow(add, f"{CUT_SCHEMA}, {', '.join(f'{k} long' for k in KEYS)}")


class Bm25:
    """Inverted index over the ids of a shard's rests."""

    def __init__(self, rests: list[np.ndarray]):
        lengths = np.array([len(r) for r in rests], float)
        owner = np.repeat(np.arange(len(rests)), lengths.astype(int))
        span = int(max(r.max() for r in rests)) + 1
        cells, counts = np.unique(np.concatenate(rests).astype(np.int64) * len(rests) + owner, return_counts=True)
        term, self.owner = cells // len(rests), cells % len(rests)
        texts = np.bincount(term, minlength=span)
        idf = np.log(1 + (len(rests) - texts + 0.5) / (texts + 0.5))
        damped = counts + K1 * (1 - B + B * lengths[self.owner] / lengths.mean())
        self.weight = idf[term] * counts * (K1 + 1) / damped
        self.begin = np.searchsorted(term, np.arange(span + 1))
        self.size = len(rests)
        ends = np.cumsum(np.bincount(self.owner, minlength=self.size))
        self.terms = np.split(term[np.argsort(self.owner, kind="stable")], ends[:-1])

    def scores(self, rest: int) -> np.ndarray:
        """Scores of all rests for the ids of one of them."""
        terms = self.terms[rest]
        first, count = self.begin[terms], self.begin[terms + 1] - self.begin[terms]
        at = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        return np.bincount(self.owner[at], self.weight[at], minlength=self.size)


def pack_rests(lengths: list[int], neighbours) -> list[list[tuple[int, int, int]]]:
    """Windows of (rest, first id, number of ids); all but the last are full.

    `lengths` falls; `neighbours(rest)` gives all rests in order of their nearness.
    """
    begin, left = [0] * len(lengths), list(lengths)
    windows, seed, carried = [], 0, None
    while True:
        while seed < len(left) and not left[seed]:
            seed += 1
        first = carried if carried is not None and left[carried] else seed
        if first >= len(left):
            return windows
        window, room, carried = [], WINDOW, None

        def place(rest: int, size: int) -> None:
            window.append((rest, begin[rest], size))
            begin[rest] += size
            left[rest] -= size

        place(first, left[first])
        room -= window[0][2]
        near = neighbours(first) if room else []
        for rest in near:
            if 0 < left[rest] <= room:
                room -= left[rest]
                place(rest, left[rest])
                if not room:
                    break
        if room:
            for rest in near:
                if left[rest]:
                    place(rest, room)
                    carried = rest
                    break
        windows.append(window)


def powers_of_two(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The window as sequences whose sizes are powers of two, the largest first."""
    size = sum(n for _, _, n in window)
    out, queue = [], list(reversed(window))
    while size:
        room = 1 << (size.bit_length() - 1)
        size -= room
        part = []
        while room:
            rest, start, n = queue.pop()
            taken = min(n, room)
            part.append((rest, start, taken))
            if taken < n:
                queue.append((rest, start + taken, n - taken))
            room -= taken
        out.append(part)
    return out


def pack_shard(rows: pa.Table, shard: int) -> pa.Table:
    """All pieces of one shard with their sequences."""
    rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]).to_pydict()
    out = []
    sequence = shard << 16
    open_rows = []
    for i, ids in enumerate(rows["ids"]):
        if ids is None:
            out.append((*(rows[c][i] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), sequence, 0))
            sequence += 1
        else:
            open_rows.append(i)
    rests = [np.frombuffer(rows["ids"][i], "<u4") for i in open_rows]
    if rests:
        index = Bm25(rests)
        windows = pack_rests([len(r) for r in rests], lambda rest: np.argsort(-index.scores(rest), kind="stable").tolist())
        if sum(n for _, _, n in windows[-1]) < WINDOW:
            windows[-1:] = powers_of_two(windows[-1])
        for window in windows:
            offset = 0
            for rest, first, size in window:
                i = open_rows[rest]
                crc = zlib.crc32(rests[rest][first : first + size].tobytes())
                out.append((rows["doc_id"][i], rows["start"][i] + first, size, crc, rows["doc_tokens"][i], sequence, offset))
                offset += size
            sequence += 1
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return pa.table([pa.array(c, pa.int64()) for c in zip(*out)], names)


def pack_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of a task in shards of SHARD_ROWS that follow each other."""
    shard, parts, size = TaskContext.get().partitionId() << 20, [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, SHARD_ROWS - size)
            batch = batch.slice(part.num_rows)
            parts.append(part)
            size += part.num_rows
            if size == SHARD_ROWS:
                yield from pack_shard(pa.Table.from_batches(parts), shard).to_batches()
                shard, parts, size = shard + 1, [], 0
    if parts:
        yield from pack_shard(pa.Table.from_batches(parts), shard).to_batches()


def deal_pieces(documents: DataFrame, vocabulary: str) -> DataFrame:
    """The pieces of all documents in the order of their keys, over tasks of about
    TASK_SHARDS shards."""
    pieces = written(cut_documents(documents, vocabulary), "pieces")
    texts, rests, mean = id_frequencies(pieces)
    idf = np.where(texts > 1, np.log(1 + (rests - texts + 0.5) / (texts + 0.5)), 0)
    tasks = max(1, -(-pieces.count() // (SHARD_ROWS * TASK_SHARDS)))
    order = [*KEYS, "doc_id", "start", "ids_crc32", "place"]
    keyed = written(with_keys(pieces, idf, mean), "keyed")
    return keyed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def pack_documents(documents: DataFrame, vocabulary: str) -> DataFrame:
    return deal_pieces(documents, vocabulary).mapInArrow(lambda batches: pack_sorted(batches), PACKED_SCHEMA)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
