"""Byte-pair encoding and decoding with a segment tree over adjacent pair ranks.

A text is split by the tokenizer's pattern; each word starts as its bytes. A leaf of the
tree holds the rank of the pair at its place, the root yields the lowest rank and among
equals the leftmost, one merge changes three leaves and their paths, and a word is done
when the root holds no rank. Words of one size class are merged together: their trees are
rows of one array; a very long word has a tree of its own. Merged words are remembered within a task.

A null text is empty and has no tokens. The special text <|endoftext|> becomes its own id,
as the tokenizer does; decoding puts it back. Long words cost O(n log n).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.tables import table

VOCABULARY = "byte_bpe_50k.json"
#: Words merged at once, by their bytes, and words remembered in a task.
LEAVES_AT_ONCE, REMEMBERED = 1 << 20, 400_000
#: Fixed value: how the vocabulary file cuts texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words of more bytes than this have a tree of their own.
LONG_WORD = 256
NONE = np.int64(1) << 62


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in vocabulary files: printable ones for themselves,
    the others for 256, 257, ... in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Bpe:
    """Vocabulary, merge ranks and the merging of words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = byte_letters()
        vocabulary = model["model"]["vocab"]
        size = max(*vocabulary.values(), *(x["id"] for x in model["added_tokens"])) + 1
        self.bytes_of = np.full(size, b"", dtype=object)
        for text, i in vocabulary.items():
            self.bytes_of[i] = bytes(letters[c] for c in text)
        self.special = {x["content"]: x["id"] for x in model["added_tokens"]}
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.first_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.first_ids[byte] = vocabulary[letter]
        self.width = np.int64(size)
        merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["model"]["merges"]]
        keys = np.array([vocabulary[a] * size + vocabulary[b] for a, b in merges], np.int64)
        made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        self.pattern = regex.compile(PATTERN)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pairs: dict[int, int] = {}
        self.words: dict[str, bytes] = {}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; NONE where they never merge or one is missing (-1)."""
        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        known = (self.keys[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(known, self.ranks[at], NONE)

    def merge_class(self, ids: np.ndarray) -> np.ndarray:
        """Merges words given as rows of ids, padded by -1; returns rows with -1 for gaps."""
        n, leaves = ids.shape
        step = np.int64(leaves)
        place = np.arange(leaves, dtype=np.int64)
        following = np.tile(place + 1, (n, 1))
        previous = np.tile(place - 1, (n, 1))
        tree = np.full((n, 2 * leaves), NONE)
        ranks = self.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, leaves - 1)
        tree[:, leaves:-1] = np.where(ranks == NONE, NONE, ranks * step + place[:-1])
        level = leaves
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        active = np.flatnonzero(tree[:, 1] != NONE)
        while len(active):
            root = tree[active, 1]
            at, rank = root % step, root // step
            gone = following[active, at]
            after, before = following[active, gone], previous[active, at]
            ids[active, at], ids[active, gone] = self.made[rank], -1
            following[active, at] = after
            inner = after < leaves
            previous[active[inner], after[inner]] = at[inner]
            next_id = np.where(inner, ids[active, np.minimum(after, leaves - 1)], -1)
            last_id = np.where(before >= 0, ids[active, np.maximum(before, 0)], -1)
            merged = ids[active, at]
            for leaf, left, right in ((at, merged, next_id), (gone, np.full_like(at, -1), next_id), (before, last_id, merged)):
                rows, spot = active, leaf
                ranks = self.pair_ranks(left, right)
                value = np.where(ranks == NONE, NONE, ranks * step + leaf)
                if leaf is before:
                    real = before >= 0
                    rows, spot, value = active[real], leaf[real], value[real]
                node = spot + leaves
                tree[rows, node] = value
                while len(node) and node[0] > 1:
                    node = node >> 1
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            active = active[tree[active, 1] != NONE]
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """Merges one word with a tree of its own, for words too long for shared rows."""
        if not self.pairs:
            self.pairs = dict(zip(self.keys.tolist(), self.ranks.tolist()))
        pairs, made, width, none = self.pairs, self.made, int(self.width), int(NONE)
        n = len(ids)
        leaves = 1 << (n - 1).bit_length()
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))

        def value(at: int) -> int:
            after = following[at]
            rank = pairs.get(ids[at] * width + ids[after]) if after < n else None
            return none if rank is None else rank * leaves + at

        tree = [none] * (2 * leaves)
        tree[leaves : leaves + n] = map(value, range(n))
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(at: int, leaf: int) -> None:
            node = at + leaves
            tree[node] = leaf
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least

        while tree[1] != none:
            rank, at = divmod(tree[1], leaves)
            gone = following[at]
            ids[at], ids[gone] = int(made[rank]), -1
            following[at] = following[gone]
            if following[at] < n:
                previous[following[at]] = at
            put(gone, none)
            put(at, value(at))
            if previous[at] >= 0:
                put(previous[at], value(previous[at]))
        return [i for i in ids if i >= 0]

    def learn_words(self, words: list[str]) -> None:
        """Adds the ids of words, as little-endian 32-bit integers, to the memory."""
        classes: dict[int, list[tuple[str, bytes]]] = {}
        for word in words:
            data = word.encode()
            if len(data) == 1:
                self.words[word] = int(self.first_ids[data[0]]).to_bytes(4, "little")
            elif len(data) > LONG_WORD:
                ids = self.first_ids[np.frombuffer(data, np.uint8)].tolist()
                self.words[word] = np.array(self.merge_long(ids), "<u4").tobytes()
            else:
                classes.setdefault(max(8, 1 << (len(data) - 1).bit_length()), []).append((word, data))
        for leaves, members in classes.items():
            for first in range(0, len(members), max(1, LEAVES_AT_ONCE // leaves)):
                part = members[first : first + max(1, LEAVES_AT_ONCE // leaves)]
                sizes = np.array([len(data) for _, data in part])
                ids = np.full((len(part), leaves), -1, np.int64)
                inside = np.arange(leaves) < sizes[:, None]
                ids[inside] = self.first_ids[np.frombuffer(b"".join(data for _, data in part), np.uint8)]
                ids = self.merge_class(ids)
                kept = ids >= 0
                flat = ids[kept].astype("<u4").tobytes()
                ends = (np.cumsum(kept.sum(axis=1)) * 4).tolist()
                start = 0
                for (word, _), end in zip(part, ends):
                    self.words[word] = flat[start:end]
                    start = end

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        split = []
        for text in texts:
            if self.cut and any(x in text for x in self.special):
                pieces, last = [], 0
                for found in self.cut.finditer(text):
                    pieces += [self.pattern.findall(text[last : found.start()]), found.group()]
                    last = found.end()
                split.append([*pieces, self.pattern.findall(text[last:])])
            else:
                split.append([self.pattern.findall(text)])
        if len(self.words) > REMEMBERED:
            self.words.clear()
        wanted = set()
        for pieces in split:
            for piece in pieces:
                if not isinstance(piece, str):
                    wanted.update(piece)
        self.learn_words([word for word in wanted if word not in self.words])
        ids = self.words.__getitem__
        special = {text: i.to_bytes(4, "little") for text, i in self.special.items()}
        return [b"".join(special[p] if isinstance(p, str) else b"".join(map(ids, p)) for p in pieces) for pieces in split]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self.bytes_of[ids].tolist()).decode("utf-8", "replace")


#: Characters of texts encoded together.
BATCH_CHARACTERS = 4_000_000


def text_groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= BATCH_CHARACTERS:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode_documents(documents: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and decoded text of every document."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary)
        for batch in batches:
            row = 0
            for group in text_groups(batch.column("text").to_pylist()):
                found = bpe.encode_batch(group)
                decoded = [bpe.decode(np.frombuffer(ids, "<u4")) for ids in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, len(group)), pa.array(found, pa.binary()), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "decoded"],
                )
                row += len(group)

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(encode, "doc_id long, ids binary, decoded string")


def digest_documents(documents: DataFrame, vocabulary: str) -> DataFrame:
    """Token counts and digests of `encode_documents`, without moving the ids themselves."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary)
        for batch in batches:
            out: list[list] = [[], [], []]
            for group in text_groups(batch.column("text").to_pylist()):
                for ids in bpe.encode_batch(group):
                    out[0].append(len(ids) // 4)
                    out[1].append(hashlib.sha256(ids).hexdigest())
                    out[2].append(hashlib.sha256(bpe.decode(np.frombuffer(ids, "<u4")).encode()).hexdigest())
            columns = [batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
