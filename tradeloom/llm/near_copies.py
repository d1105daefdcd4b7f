"""Near copies by bottom-k sketches of one hash function.

A document's set is that of its hashed 5-word shingles; its sketch the SKETCH smallest of
them. Documents with equal sets form a class and go on as one. Retained values are put
into inverted lists: of each class's LISTED smallest, rarest first, as many that two
classes above the threshold share a list unless their overlap falls 5 standard deviations
short (a chance of some 1e-7 for a pair at the threshold itself, less beyond). A list's
most common-looking class is its pivot, and all classes listed with a pivot are its family.

First every member is held against its pivot; what the union sketch does not rule out is
verified on full sets, and verified links join classes to components. Then members of one
family that are still in different components are held against each other on full sets, in
blocks of bounded size that return joining links only. So a large group of copies costs a
star of links, not all its pairs, and no list is cut.

Documents without words have an empty set and are linked with nothing, as are null texts;
fewer than 5 words make one shingle. Rows that repeat an id with equal text are alike in
the result; a null id is no node, but gets the component of its set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.components import components
from tradeloom.llm.tables import free_name, table, written
from tradeloom.llm.words import LOWER, WHITE, RangeHash, mix, text_chunks, token_bounds

WORDS = 5
#: Linked if 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Values of a sketch, of its part that goes into lists, and the least overlap of two such
#: parts of linked documents (mean less 5.7 standard deviations).
SKETCH, LISTED, LEAST_SHARED = 96, 64, 38
#: Standard deviations of the union-sketch estimate that a pair may fall short.
SPREADS = 4.0
#: Shingles of a block of a family; two blocks are compared at once.
BLOCK_SHINGLES = 200_000
IS_WORD = (~WHITE).astype(np.uint8)


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in rising order, text by text, and where each text's begin."""
    lowered = LOWER[data]
    starts, ends, text = token_bounds(lowered, bounds, IS_WORD)
    word = RangeHash(lowered)(starts, ends)
    counts = np.bincount(text, minlength=len(bounds) - 1)
    found, owner = [], []
    if len(word) >= WORDS:
        whole = text[WORDS - 1 :] == text[: len(text) - WORDS + 1]
        value = word[: len(word) - WORDS + 1].copy()
        for i in range(1, WORDS):
            value = mix(value * np.uint64(3)) + word[i : len(word) - WORDS + 1 + i]
        found.append(mix(value)[whole])
        owner.append(text[WORDS - 1 :][whole])
    first = np.cumsum(counts) - counts
    for size in range(1, WORDS):
        short = np.flatnonzero(counts == size)
        value = word[first[short]].copy()
        for i in range(1, size):
            value = mix(value * np.uint64(3)) + word[first[short] + i]
        found.append(mix(value + np.uint64(size)))
        owner.append(short)
    value, owner = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(bounds)))


def as_long(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def sketch_documents(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two digests of the set, and its sketch."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in text_chunks(batch.column("text")):
                values, begin = shingle_sets(data, bounds)
                sizes = np.diff(begin)
                running = [np.concatenate([[np.uint64(0)], np.cumsum(mix(values + np.uint64(salt)), dtype=np.uint64)]) for salt in (17, 91)]
                digests = [as_long(r[begin[1:]] - r[begin[:-1]]) for r in running]
                kept = np.minimum(sizes, SKETCH)
                at = np.repeat(begin[:-1] - (np.cumsum(kept) - kept), kept) + np.arange(kept.sum())
                sketches = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(kept)]).astype(np.int32), pa.array(as_long(values[at])))
                columns = [batch.column("doc_id").slice(first, len(sizes)), pa.array(sizes), *map(pa.array, digests), sketches]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest_a", "digest_b", "sketch"])

    schema = "doc_id long, n_shingles long, digest_a long, digest_b long, sketch array<long>"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sketch, schema)


SET = ["n_shingles", "digest_a", "digest_b"]


def classes_of(sketches: DataFrame) -> DataFrame:
    """class_id (least id), set size and sketch of every distinct set that is not empty."""
    rows = sketches.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    return rows.groupBy(*SET).agg(F.min("doc_id").alias("class_id"), F.min("sketch").alias("sketch"))


def listed_values(classes: DataFrame) -> DataFrame:
    """value, class_id and weight: the rarest listed values of each class that others share.

    Two linked classes share LEAST_SHARED listed values at least, so all but that many less
    one of a class's values, taken in one order for all classes, suffice to meet.
    """
    listed = classes.select("class_id", "n_shingles", F.explode(F.slice("sketch", 1, LISTED)).alias("value"))
    counts = listed.groupBy("value").agg(F.count("*").alias("lists")).where("lists > 1")
    shared = listed.join(written(counts, "counts"), "value")
    held = F.least(F.col("n_shingles"), F.lit(LISTED))
    least = F.least(F.ceil(F.col("n_shingles") * PERCENT / 100), F.lit(LEAST_SHARED))
    gathered = shared.groupBy("class_id", "n_shingles").agg(F.sort_array(F.collect_list(F.struct("lists", "value"))).alias("found"))
    weight = F.size("found")
    room = F.greatest(F.lit(0), held - least + 1 - (held - weight)).cast("int")
    rarest = gathered.withColumn("weight", weight).withColumn("found", F.slice("found", 1, room))
    return rarest.select("class_id", "n_shingles", "weight", F.explode("found").alias("found")).select("class_id", "n_shingles", "weight", F.col("found.value").alias("value"))


def families(lists: DataFrame) -> DataFrame:
    """pivot and class_id, distinct, of all classes listed with a pivot, pivots included."""
    best = lists.groupBy("value").agg(
        F.max(F.struct("weight", (-F.col("class_id")).alias("id"))).alias("best"), F.count("*").alias("n")
    )
    pivots = best.where("n > 1").select("value", (-F.col("best.id")).alias("pivot"))
    return lists.join(written(pivots, "pivots"), "value").select("pivot", "class_id").distinct()


def short_of(shared: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Pairs whose union-sketch overlap rules out a link."""
    part = PERCENT / 100
    return shared < part * size - SPREADS * np.sqrt(part * (1 - part) * size)


def union_overlap(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Values of the union sketch that both hold, and its size."""
    values, counts = np.unique(np.concatenate([a, b]), return_counts=True)
    size = min(len(values), SKETCH) if len(a) == SKETCH or len(b) == SKETCH else len(values)
    return int((counts[:size] == 2).sum()), size


def likely_links(pairs: DataFrame) -> DataFrame:
    """(a, b) whose sketches do not rule out a link."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = np.zeros(batch.num_rows, bool)
            sketches = [[np.asarray(x.values).view(np.uint64) for x in batch.column(c)] for c in ("sketch_a", "sketch_b")]
            for i, (a, b) in enumerate(zip(*sketches)):
                shared, size = union_overlap(a, b)
                flags[i] = not short_of(np.array(shared), np.array(size))
            yield batch.select(["a", "b"]).filter(pa.array(flags))

    return pairs.select("a", "b", "sketch_a", "sketch_b").mapInArrow(keep, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked on full sets."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = np.zeros(batch.num_rows, bool)
            right = batch.column("text_b")
            for first, data, bounds in text_chunks(batch.column("text_a")):
                values, begin = shingle_sets(data, bounds)
                for i in range(len(begin) - 1):
                    a = values[begin[i] : begin[i + 1]]
                    (_, other, edges), *_ = text_chunks(right.slice(first + i, 1))
                    b, _ = shingle_sets(other, edges)
                    both = len(a) + len(b) - len(np.union1d(a, b))
                    flags[first + i] = 100 * both >= PERCENT * (len(a) + len(b) - both)
            yield batch.select(["a", "b"]).filter(pa.array(flags))

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def full_sets(texts: DataFrame) -> DataFrame:
    """class_id and all shingle hashes of texts."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in text_chunks(batch.column("text")):
                values, begin = shingle_sets(data, bounds)
                lists = pa.ListArray.from_arrays(begin.astype(np.int32), pa.array(as_long(values)))
                yield pa.RecordBatch.from_arrays([batch.column("class_id").slice(first, len(lists)), lists], ["class_id", "shingles"])

    return texts.select("class_id", "text").mapInArrow(sets, "class_id long, shingles array<long>")


def links_in_cell(cell: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links between members of two blocks (or within one) of a family, on full sets.

    An inverted list over the second block gives the overlaps of one member with all of
    it. Only pairs of different components are looked at, and each link found joins its
    two, so a cell returns fewer links than it has members.
    """
    i, j = cell[1], cell[2]
    rows = rows.sort_values("class_id")
    left, right = rows[rows["own"] == i], rows[rows["own"] == j]
    if left.empty or right.empty:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    names, group = np.unique(rows["component"], return_inverse=True)
    group_of = dict(zip(rows["class_id"], group))
    joined = np.arange(len(names))
    ids, sizes = right["class_id"].to_numpy(), right["n_shingles"].to_numpy()
    groups = np.array([group_of[x] for x in ids])
    sets = [np.asarray(x, np.int64) for x in right["shingles"]]
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(flat, kind="stable")
    values, begin = np.unique(flat[order], return_index=True)
    begin, owner = np.append(begin, len(flat)), owner[order]
    out = []
    for a, size, mine in zip(left["class_id"], left["n_shingles"], left["shingles"]):
        open_pair = (joined[groups] != joined[group_of[a]]) & (100 * np.minimum(sizes, size) >= PERCENT * np.maximum(sizes, size))
        if not open_pair.any():
            continue
        mine = np.asarray(mine, np.int64)
        at = np.minimum(np.searchsorted(values, mine), len(values) - 1)
        at = at[values[at] == mine]
        count = begin[at + 1] - begin[at]
        places = np.repeat(begin[at] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        both = np.bincount(owner[places], minlength=len(sets))
        linked = open_pair & (100 * both >= PERCENT * (size + sizes - both))
        for b in np.flatnonzero(linked):
            old, new = joined[groups[b]], joined[group_of[a]]
            if old != new:
                joined[joined == old] = new
                out.append((a, ids[b]))
    return pd.DataFrame(out, columns=["a", "b"]).astype(np.int64)


def open_links(family: DataFrame, classes: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between members of one family that are in different components."""
    named = classes.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    named = written(named.select("class_id", "n_shingles", F.coalesce("component", "class_id").alias("component")), "named")
    members = written(family.join(named, "class_id"), "members")
    counts = members.groupBy("pivot").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.sum("n_shingles").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK_SHINGLES).cast("int")
    mixed = written(counts.where("x <> y").select("pivot", blocks.alias("blocks")), "mixed")
    members = written(members.join(mixed, "pivot"), "mixed_members")
    wanted = written(members.select("class_id").distinct(), "wanted")
    sets = written(full_sets(texts.withColumnRenamed("doc_id", "class_id").join(wanted, "class_id")), "sets")
    own = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    rows = members.withColumn("own", own).join(sets, "class_id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("pivot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "class_id", "component", "n_shingles", "shingles")
    return rows.groupBy("pivot", "i", "j").applyInPandas(lambda cell, part: links_in_cell(cell, part), "a long, b long").distinct()


def group_copies(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document row."""
    sketches = written(sketch_documents(documents), "sketches")
    classes = written(classes_of(sketches), "classes")
    family = written(families(written(listed_values(classes), "lists")), "families")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    side = classes.select("class_id", "n_shingles", "sketch")
    star = (
        family.where("pivot <> class_id")
        .join(side.select(F.col("class_id"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("sketch_b")), "class_id")
        .join(side.select(F.col("class_id").alias("pivot"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("sketch_a")), "pivot")
        .where(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
        .select(F.col("pivot").alias("a"), F.col("class_id").alias("b"), "sketch_a", "sketch_b")
    )
    links = written(verified(written(likely_links(star), "likely"), texts), "verified")
    found = written(components(links), "components")
    more = written(open_links(family, classes, found, texts), "more")
    found = written(components(links.union(more)), "components")
    labels = classes.join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    labels = written(labels.select(*SET, F.coalesce("component", "class_id").alias("component_id")), "labels")
    grouped = sketches.drop("sketch").join(labels, SET, "left")
    return grouped.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first_copies(documents: DataFrame) -> DataFrame:
    """The documents, all columns, exactly one row of each component.

    Components are those of the texts, so repeated and null ids are grouped as well. The row
    with the least id stays (a null id is the largest), then the one with the least digest;
    of equal rows one stays. Without words a text has no copies: of equal rows with an id
    one stays, rows with a null id all stay.
    """
    tag = free_name(documents, "copied")
    marks = [f"{tag}_a", f"{tag}_b"]
    hashed = [F.col(f"`{x.name}`") for x in documents.schema if "map<" not in x.dataType.simpleString()]
    salted = [*(c.isNull() for c in hashed), *hashed]
    text = F.coalesce(F.col("text"), F.lit(""))
    digests = dict(zip(marks, (F.xxhash64(*salted), F.xxhash64(F.lit("second"), *salted))))
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.rlike(r"[^\x20\x09-\x0D]").alias("words"),
        F.xxhash64(text).alias("text_id"),
        *(value.alias(name) for name, value in zip(("a", "b"), digests.values())),
    )
    rows = written(rows.groupBy("doc_id", "words", "text_id", "a", "b").agg(F.count("*").alias("n")), "rows")
    grouped = group_copies(documents.select(F.xxhash64(text).alias("doc_id"), "text")).where("n_shingles > 0")
    grouped = grouped.groupBy(F.col("doc_id").alias("text_id")).agg(F.min("component_id").alias("component"))
    rank = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "a", "b")).alias("best")
    first = rows.where("words").groupBy("text_id").agg(rank).join(grouped, "text_id").groupBy("component").agg(F.min("best").alias("best"))
    first = written(first.select("best.a", "best.b", F.lit(True).alias("first")), "first")
    named = rows.join(first, ["a", "b"], "left")
    gone = named.where("words and first is null").select("a", "b", F.lit(False).alias("again"))
    again = named.where("n > 1 and (first or (not words and doc_id is not null))").select("a", "b", F.lit(True).alias("again"))
    listed = written(gone.union(again).distinct().toDF(*marks, tag), "copied")
    marked = documents.withColumns(digests)
    once = marked.join(listed, marks, "left_anti")
    repeated = marked.join(listed.where(F.col(tag)), marks, "left_semi").dropDuplicates(marks)
    return once.unionByName(repeated).drop(*marks)


def op6_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_copies(table(spark, sf_dir, "documents")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


OP6_SQL = r"""
with recursive words as (
    select doc_id, list_filter(
        string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+'),
        lambda w: w <> '') as w
    from documents
), sets as (
    select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
    from words
), items as (
    select doc_id, len(s) as n, unnest(s) as item from sets
), links as (
    select a.doc_id as a, b.doc_id as b
    from items a join items b on a.item = b.item and a.doc_id < b.doc_id
    group by all having 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), both_ways as (
    select a, b from links union all select b, a from links
), reach(doc_id, other) as (
    select doc_id, doc_id from sets
    union
    select reach.doc_id, both_ways.b from reach join both_ways on both_ways.a = reach.other
)
select sets.doc_id, cast(len(s) as bigint) as n_shingles, least_id as component_id, sets.doc_id = least_id as kept
from sets join (select doc_id, min(other) as least_id from reach group by doc_id) using (doc_id)
"""
