"""Removal of passages that occur elsewhere, by sharded suffix arrays.

Every start of a string of the given length (a window; 400 bytes, if none is given) belongs
to an anchor: the leftmost of the least hashed strings of 8/25 of that length inside it. Equal windows have equal anchors at equal places,
so a window can only repeat where its anchor does. Windows with one anchor make a segment.

1. Anchors are counted over all documents; those that occur once are done with.
2. A segment that occurs more than once repeats as a whole: counting it is enough.
3. The distinct segments of anchors that have several are gathered, anchor by anchor, into
   blocks of bounded size; a block's suffix array (two-stage sorting) and adjacent common
   prefixes of the windows show which of them repeat in it. An anchor with very many distinct segments is
   not put into one block: its windows are counted one by one instead, by their hashes.
4. Each document loses the bytes of its repeating windows.

A null text is empty; texts shorter than a window keep all bytes. Rows that repeat are
copies of each other. Texts are told apart by two 64-bit hashes, anchors and segments
likewise; nothing depends on the order or the files of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.suffixes import common_prefixes, suffix_array
from tradeloom.llm.tables import free_name, table, written
from tradeloom.llm.words import RangeHash, replace_texts, text_bytes, text_chunks

#: Length of a repeat, if none is given.
REPEAT = 400
#: Bytes of segments in a block, and distinct segments from which on windows are counted.
BLOCK_BYTES, MOST_SEGMENTS = 512 << 10, 512
CHUNK = 1 << 18


def digests(text: Column) -> list[Column]:
    known = F.coalesce(text, F.lit(""))
    return [F.xxhash64(known).alias("text_a"), F.xxhash64(F.lit("second"), known).alias("text_b")]


TEXT = ["text_a", "text_b"]


def anchor_length(repeat: int) -> int:
    """Length of the hashed strings that serve as anchors of windows of so many bytes."""
    return repeat * 8 // 25


def least_places(values: np.ndarray, span: int) -> np.ndarray:
    """For each run of `span` values the place of the leftmost least one.

    Running minima from both ends of blocks of `span` values; places ride in the low bits.
    """
    n = len(values)
    bits = np.uint64(span.bit_length())
    blocks = -(-n // span)
    keys = np.full(blocks * span, ~np.uint64(0))
    keys[:n] = (values >> bits) << bits
    grid = keys.reshape(blocks, span) | np.arange(span, dtype=np.uint64)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.arange(n - span + 1)
    left, right = behind[starts], ahead[starts + span - 1]
    low = (np.uint64(1) << bits) - np.uint64(1)
    from_left = (left >> bits) <= (right >> bits)
    place = (np.where(from_left, left, right) & low).astype(np.int64)
    return place + np.where(from_left, starts // span, (starts + span - 1) // span) * span


def chunk_segments(data: np.ndarray, bounds: np.ndarray, repeat: int):
    """(text number, anchor hash, first window, windows, anchor's place, segment hash) of all
    segments, in order; places count from the text's first byte."""
    n = len(data)
    if n < repeat:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    ranges, anchor = RangeHash(data), anchor_length(repeat)
    at = np.arange(n - anchor + 1)
    anchor_hash = ranges(at, at + anchor)
    place = least_places(anchor_hash, repeat - anchor + 1)
    windows = np.arange(n - repeat + 1)
    owner = np.searchsorted(bounds, windows, "right") - 1
    windows = windows[windows + repeat <= bounds[owner + 1]]
    owner, place = owner[windows], place[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(windows)))
    start, owner, place = windows[first], owner[first], place[first]
    whole = ranges(start, start + count - 1 + repeat)
    return owner, anchor_hash[place], start - bounds[owner], count, place - start, whole


def segments_of(documents: DataFrame, repeat: int) -> DataFrame:
    """doc_id, text digests and the segments of every document with a window."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in text_chunks(batch.column("text"), CHUNK):
                owner, *columns = chunk_segments(data, bounds, repeat)
                if not len(owner):
                    continue
                texts, begin = np.unique(owner, return_index=True)
                rows = pa.array(first + texts)
                offsets = pa.array(np.append(begin, len(owner)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.asarray(c).astype(t).view(s))) for c, t, s in zip(columns, (np.uint64, *[np.int32] * 3, np.uint64), (np.int64, *[np.int32] * 3, np.int64))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in ("doc_id", *TEXT)), *lists], ["doc_id", *TEXT, *SEGMENT])

    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id"), "text", *digests(F.col("text")))
    schema = "doc_id long, text_a long, text_b long, anchor array<long>, start array<int>, windows array<int>, place array<int>, content array<long>"
    return rows.mapInArrow(find, schema)


SEGMENT = ["anchor", "start", "windows", "place", "content"]
SAME = ["anchor", "windows", "place", "content"]


def shared_segments(segments: DataFrame) -> DataFrame:
    """The segments whose anchor occurs more than once; `mixed` if they are not all equal."""
    rows = segments.select("doc_id", *TEXT, F.inline(F.arrays_zip(*SEGMENT)))
    kind = F.xxhash64("windows", "place", "content")
    counted = rows.groupBy("anchor").agg(F.count("*").alias("n"), F.min(kind).alias("x"), F.max(kind).alias("y"))
    shared = written(counted.where("n > 1").select("anchor", (F.col("x") != F.col("y")).alias("mixed")), "anchors")
    return rows.join(shared, "anchor")


def fetch_segments(documents: DataFrame, chosen: DataFrame, repeat: int) -> DataFrame:
    """The bytes of chosen segments: one row each, and the documents read once."""
    listed = chosen.groupBy("doc_id", *TEXT).agg(F.collect_list(F.struct("anchor", "start", "windows", "single", "hot", "block")).alias("found"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = (batch.column("text")[row].as_py() or "").encode()
                found = batch.column("found")[row].as_py()
                pieces = [data[x["start"] : x["start"] + x["windows"] - 1 + repeat] for x in found]
                fixed = [pa.array([batch.column(c)[row].as_py()] * len(found), pa.int64()) for c in TEXT]
                yield pa.RecordBatch.from_arrays(
                    [*fixed, *(pa.array([x[c] for x in found], t) for c, t in CHOSEN), pa.array(pieces, pa.binary())],
                    [*TEXT, *(c for c, _ in CHOSEN), "piece"],
                )

    texts = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id"), "text", *digests(F.col("text")))
    joined = texts.join(listed, ["doc_id", *TEXT]).select(*TEXT, "text", "found")
    return joined.mapInArrow(cut, "text_a long, text_b long, anchor long, start int, windows int, single boolean, hot boolean, block long, piece binary")


CHOSEN = [("anchor", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("single", pa.bool_()), ("hot", pa.bool_()), ("block", pa.int64())]


def repeats_in_block(rows: pa.Table, repeat: int) -> pa.Table:
    """Runs of repeating windows of a block's segments: text digests, first and end byte."""
    pieces, bounds = piece_bytes(rows.column("piece"))
    start, windows = (rows.column(c).to_numpy().astype(np.int64) for c in ("start", "windows"))
    wanted = covered(bounds[:-1], bounds[:-1] + windows, len(pieces))
    order = suffix_array(pieces, repeat, wanted)
    same = common_prefixes(pieces, order, repeat) >= repeat
    group = np.cumsum(~same)
    repeating = np.zeros(len(pieces), bool)
    repeating[order[np.bincount(group)[group] > 1]] = True
    at = np.flatnonzero(repeating)
    owner = np.searchsorted(bounds, at, "right") - 1
    kept = rows.column("single").to_numpy()[owner]
    at, owner = at[kept], owner[kept]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    places = start[owner[first]] - bounds[owner[first]]
    keys = [rows.column(c).to_numpy()[owner[first]] for c in TEXT]
    return pa.table([*map(pa.array, keys), pa.array(at[first] + places), pa.array(at[last] + places + repeat)], [*TEXT, "first", "end"])


def piece_bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    pieces = [x.as_py() for x in column]
    return np.frombuffer(b"".join(pieces), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in pieces])])


def counted_windows(pieces: DataFrame, repeat: int) -> DataFrame:
    """Repeating windows of anchors with very many segments, by counts of window hashes."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = np.frombuffer(batch.column("piece")[row].as_py(), np.uint8)
                n, start = batch.column("windows")[row].as_py(), batch.column("start")[row].as_py()
                at = np.arange(n)
                value = RangeHash(data)(at, at + repeat)
                keys = [np.full(n, batch.column(c)[row].as_py()) for c in ("anchor", *TEXT)]
                single = np.full(n, batch.column("single")[row].as_py())
                yield pa.RecordBatch.from_arrays([*map(pa.array, (*keys, value.view(np.int64), start + at, single))], ["anchor", *TEXT, "value", "first", "single"])

    rows = written(pieces.mapInArrow(windows, "anchor long, text_a long, text_b long, value long, first long, single boolean"), "windows")
    many = written(rows.groupBy("anchor", "value").count().where("count > 1").select("anchor", "value"), "counted")
    return rows.where("single").join(many, ["anchor", "value"], "left_semi").select(*TEXT, "first", (F.col("first") + repeat).alias("end"))


def repeated_ranges(documents: DataFrame, repeat: int = REPEAT) -> DataFrame:
    """text_a, text_b, first and end of byte ranges that repeat; ranges may overlap."""
    shared = written(shared_segments(written(segments_of(documents, repeat), "segments")), "shared")
    copies = shared.where("mixed").groupBy(*SAME).agg(F.count("*").alias("n"), F.min(F.struct("doc_id", *TEXT, "start")).alias("one"))
    copies = written(copies, "copies")
    # All shared segments repeat as a whole but those that are the only one of their kind.
    alone = copies.where("n = 1").select("one.text_a", "one.text_b", "one.start", "windows", F.lit(True).alias("alone"))
    listed = shared.select(*TEXT, "start", "windows", F.lit(False).alias("alone")).unionByName(alone)
    whole = listed.groupBy(*TEXT, "start").agg(F.max("windows").alias("windows"), F.max("alone").alias("alone")).where("not alone")
    span = (F.col("start").cast("long").alias("first"), (F.col("start") + F.col("windows") - 1 + repeat).cast("long").alias("end"))
    per_anchor = copies.groupBy("anchor").agg(F.count("*").alias("segments"), F.sum(F.col("windows") + repeat).alias("bytes"))
    per_anchor = written(per_anchor.where("segments > 1"), "anchors")
    size = per_anchor.where(F.col("segments") <= MOST_SEGMENTS).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    blocks = -(-size // BLOCK_BYTES) + 1
    marks = per_anchor.select("anchor", (F.col("segments") > MOST_SEGMENTS).alias("hot"), F.pmod(F.xxhash64("anchor"), F.lit(blocks)).alias("block"))
    chosen = copies.join(marks, "anchor").select("anchor", "windows", "one.*", (F.col("n") == 1).alias("single"), "hot", "block")
    pieces = written(fetch_segments(documents, written(chosen, "chosen"), repeat), "pieces")
    sorted_blocks = pieces.where("not hot").groupBy("block").applyInArrow(
        lambda rows: repeats_in_block(rows, repeat), "text_a long, text_b long, first long, end long"
    )
    return whole.select(*TEXT, *span).union(sorted_blocks).union(counted_windows(pieces.where("hot"), repeat))


def covered(first: list[int], end: list[int], size: int) -> np.ndarray:
    """Which bytes the ranges cover."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, end, -1)
    return np.cumsum(steps[:-1]) > 0


def with_ranges(documents: DataFrame, tag: str, repeat: int) -> DataFrame:
    """The documents, all columns, with the lists of first and end bytes that repeat (or
    null) in the columns `tag`_first and `tag`_end."""
    found = repeated_ranges(documents, repeat).distinct().groupBy(*TEXT)
    listed = written(found.agg(F.collect_list(F.struct("first", "end")).alias("found")), "ranges")
    names = {"text_a": f"{tag}_a", "text_b": f"{tag}_b", "found.first": f"{tag}_first", "found.end": f"{tag}_end"}
    listed = listed.select(*(F.col(old).alias(new) for old, new in names.items()))
    keys = dict(zip((f"{tag}_a", f"{tag}_b"), digests(F.col("text"))))
    return documents.withColumns(keys).join(listed, list(keys), "left").drop(*keys)


def digest_removals(documents: DataFrame, repeat: int = REPEAT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of what is left."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            out: list[list] = [[], [], [], []]
            for row in range(batch.num_rows):
                text = data[bounds[row] : bounds[row + 1]]
                first, gone, spans = batch.column("found_first")[row].as_py(), 0, 0
                if first:
                    flags = covered(first, batch.column("found_end")[row].as_py(), len(text))
                    gone = int(flags.sum())
                    spans = int(flags[0]) + int((flags[1:] & ~flags[:-1]).sum())
                    text = text[~flags]
                for column, value in zip(out, (int(bounds[row + 1] - bounds[row]), gone, spans, hashlib.sha256(text.tobytes()).hexdigest())):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(out, types))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = with_ranges(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "found", repeat)
    return rows.select("doc_id", "text", "found_first", "found_end").mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def kept_text(text: str, first: list[int], end: list[int]) -> str:
    """The text without the characters all of whose bytes are removed."""
    data = np.frombuffer(text.encode(), np.uint8)
    flags = covered(first, end, len(data))
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    gone = np.minimum.reduceat(flags, starts)
    return data[~np.repeat(gone, np.diff(np.append(starts, len(data))))].tobytes().decode()


def drop_repeats(documents: DataFrame, repeat: int = REPEAT) -> DataFrame:
    """The documents, all rows and columns, without passages of `repeat` bytes or more that
    occur elsewhere; n_chars follows."""
    names, tag = documents.columns, free_name(documents, "found")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, end = batch.column(f"{tag}_first"), batch.column(f"{tag}_end")
            rows = np.flatnonzero(np.asarray(first.is_valid())).tolist()
            new = {r: kept_text(batch.column("text")[r].as_py(), first[r].as_py(), end[r].as_py()) for r in rows}
            yield replace_texts(batch.select(names), new)

    return with_ranges(documents, tag, repeat).select(*names, f"{tag}_first", f"{tag}_end").mapInArrow(drop, documents.schema)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_removals(table(spark, sf_dir, "documents"))
