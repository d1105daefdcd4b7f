"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over block-max lists.

Terms are words (letters, ASCII lower-cased) and the first 4 and 5 bytes of longer words.
The vocabulary holds all terms of a bounded labelled sample. A term's idf comes from its
document frequency over all documents, counted in one aggregation; it is multiplied by how
far the term depends on the label (the root of chi-square, of which an independent term has
1, over the sample's distinct texts). Vectors are (1 + ln tf) times that, of unit length.
Examples are the sampled texts with a term. Their inverted lists are cut into blocks of
examples with the largest weight of each; blocks are visited by falling upper bound and the
rest is skipped once no bound can reach the k-th cosine, so the neighbours are exact (the
examples' weights are kept in single precision).
Similarity-weighted votes of the neighbours become a score by a monotone fit on examples
kept aside; a text that shares no term with an example, an empty or a null one gets the rate
of such texts. Without labelled rows of both
labels every score is the share of label 1 (0 without any). Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.tables import fold, labelled_texts, table, written
from tradeloom.llm.words import CLASSES, LOWER, RangeHash, mix, text_chunks, token_bounds

FOLDS, HELD_FOLD, THRESHOLD = 4, 2, 0.3
#: Labelled texts learned from (a quarter of them for calibration).
SAMPLE_ROWS = 12_000
NEIGHBOURS, BLOCK = 15, 256
#: A term is common if more than this part of the examples has it; weights kept as rows of
#: common terms (the longest lists first), which bounds the memory of a process.
COMMON, COMMON_CELLS = 1 / 50, 12 << 20
#: Blocks visited before the rest is held against the bound, and texts searched at once.
VISIT, SEARCHED = 2, 256
PREFIXES = (4, 5)
LETTERS = np.where(CLASSES == 1, 1, 0).astype(np.uint8)
LETTERS[48:58] = 0


def terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term hash, text number) of all occurrences."""
    lowered = LOWER[data]
    starts, ends, text = token_bounds(lowered, bounds, LETTERS)
    ranges = RangeHash(lowered)
    found, owner = [ranges(starts, ends)], [text]
    for size in PREFIXES:
        longer = ends - starts > size
        found.append(mix(ranges(starts[longer], starts[longer] + size) + np.uint64(size)))
        owner.append(text[longer])
    return np.concatenate(found), np.concatenate(owner)


def count_terms(sample: DataFrame) -> DataFrame:
    """term, number of texts and of label-1 texts with it, added up within batches first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            for first, data, bounds in text_chunks(batch.column("text"), 1 << 22):
                term, owner = terms(data, bounds)
                order = np.lexsort((owner, term))
                term, owner = term[order], owner[order]
                new = np.ones(len(term), bool)
                new[1:] = (term[1:] != term[:-1]) | (owner[1:] != owner[:-1])
                term, owner = term[new], owner[new]
                unique, at = np.unique(term, return_inverse=True)
                texts = np.bincount(at, minlength=len(unique))
                toxic = np.bincount(at, labels[first + owner], minlength=len(unique)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), pa.array(texts), pa.array(toxic)], ["term", "texts", "toxic"])

    counted = sample.select("text", "label").mapInArrow(count, "term long, texts long, toxic long")
    return counted.groupBy("term").agg(F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic"))


def document_frequencies(documents: DataFrame, hashes: np.ndarray) -> np.ndarray:
    """Number of documents with each term, and behind them the number of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, counts = Vocabulary(hashes, np.ones(len(hashes))), np.zeros(len(hashes) + 1, np.int64)
        for batch in batches:
            counts[-1] += batch.num_rows
            for _, data, bounds in text_chunks(batch.column("text")):
                _, numbers, _ = vocabulary.counted(data, bounds)
                counts += np.bincount(numbers, minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["number", "texts"])

    found = documents.select("text").mapInArrow(count, "number long, texts long").groupBy("number").agg(F.sum("texts").alias("texts")).toPandas()
    texts = np.zeros(len(hashes) + 1, np.int64)
    texts[found["number"].to_numpy(np.int64)] = found["texts"]
    return texts


@dataclass
class Vocabulary:
    """Sorted term hashes, of which there is one at least, and the weight of each."""

    hashes: np.ndarray
    weight: np.ndarray

    @cached_property
    def ranges(self) -> tuple[np.uint64, np.ndarray, np.ndarray]:
        """A shift, the place of the first hash with these leading bits (about as many
        values as hashes), and the hashes with the largest number behind them."""
        bits = len(self.hashes).bit_length()
        shift = np.uint64(64 - bits)
        begin = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << shift)
        return shift, begin, np.append(self.hashes, np.uint64(2**64 - 1))

    def places(self, term: np.ndarray) -> np.ndarray:
        """What a binary search of the hashes would give, by a look-up and short steps."""
        shift, begin, hashes = self.ranges
        at = begin[term >> shift]
        behind = np.flatnonzero(hashes[at] < term)
        while len(behind):
            at[behind] += 1
            behind = behind[hashes[at[behind]] < term[behind]]
        return at

    def counted(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, term number and count of all distinct known terms, text by text."""
        term, owner = terms(data, bounds)
        at = np.minimum(self.places(term), len(self.hashes) - 1)
        known = self.hashes[at] == term
        pairs, counts = np.unique(owner[known] * len(self.hashes) + at[known], return_counts=True)
        return pairs // len(self.hashes), pairs % len(self.hashes), counts

    def vectors(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(text number, term numbers, weights of unit length) of the texts with a term."""
        owners, numbers, counts = self.counted(data, bounds)
        texts, begin = np.unique(owners, return_index=True)
        for text, first, end in zip(texts.tolist(), begin, np.append(begin[1:], len(owners))):
            part = slice(first, end)
            yield text, numbers[part], self.unit(numbers[part], counts[part])

    def unit(self, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = (1 + np.log(counts)) * self.weight[numbers]
        return weights / np.sqrt((weights**2).sum())


def spread(begin: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all members of the chosen lists, and the sizes of these."""
    first, size = begin[which], begin[which + 1] - begin[which]
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size), size


class BlockMaxIndex:
    """Inverted lists of examples; those of common terms in blocks of examples, with the
    largest weight of a term per block.

    The short lists of all other terms are added up as a whole. What common terms can add
    to that is bounded by their block maxima and by the lengths of both vectors' common
    parts; blocks that are visited add them exactly, as one product for many texts. Examples
    are numbered anew inside, by the length of their common part, so that a block's bound is
    near that of its examples. Lists are made where the index is first asked, once per process.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, sizes: np.ndarray, numbers: np.ndarray, weights: np.ndarray, size: int):
        """Examples and, one example behind the other, their term numbers and weights."""
        self.ids, self.labels, self.size = ids, labels, size
        self.blocks = max(1, -(-len(ids) // BLOCK))
        self.given = sizes, numbers, weights
        self.rows = None

    def _build(self) -> None:
        """The lists by term; weights of common terms as rows, their lengths and the maxima
        of each block."""
        sizes, numbers, weights = self.given
        self.given = None
        lengths = np.bincount(numbers, minlength=self.size)
        longest = np.argsort(-lengths, kind="stable")[: COMMON_CELLS // max(1, len(self.ids))]
        self.common = np.sort(longest[lengths[longest] > COMMON * len(self.ids)])
        self.column = np.full(self.size, -1, np.int32)
        self.column[self.common] = np.arange(len(self.common))
        self.rows = np.zeros((self.blocks * BLOCK, len(self.common)), np.float32)
        often = np.flatnonzero(self.column[numbers] >= 0)
        end = np.cumsum(sizes)
        squares = np.bincount(np.searchsorted(end, often, "right"), weights[often].astype(float) ** 2, len(self.rows))
        self.given_number = np.argsort(squares, kind="stable")
        at, sizes = spread(np.concatenate([[0], end, np.full(len(self.rows) - len(end), len(numbers))]), self.given_number)
        numbers, weights = numbers[at], weights[at]
        del often, at
        order = np.argsort(numbers, kind="stable")
        self.begin = np.searchsorted(numbers[order], np.arange(self.size + 1))
        #: An example and its weight in one cell, so that they are fetched together.
        self.lists = np.empty(len(numbers), np.int64)
        example, weight = self.lists.view(np.int32)[::2], self.lists.view(np.float32)[1::2]
        example[:] = np.repeat(np.arange(len(self.rows), dtype=np.int32), sizes)[order]
        weight[:] = weights[order]
        del order, numbers, weights
        at, size = spread(self.begin, self.common)
        self.rows[example[at], np.repeat(np.arange(len(self.common)), size)] = weight[at]
        self.most = self.rows.reshape(self.blocks, BLOCK, -1).max(axis=1, initial=0)
        self.length = np.sqrt((self.rows.reshape(self.blocks, BLOCK, -1) ** 2).sum(axis=2).max(axis=1))
        # What a product in single precision may be off: both vectors have unit length.
        self.loss = 2 * (len(self.common) + 8) * 2.0**-24

    def _visit(self, cosines: np.ndarray, sums: np.ndarray, often: np.ndarray, wanted: np.ndarray) -> None:
        """Fill in the cosines, in single precision, of the wanted (text, block) pairs."""
        for block in np.flatnonzero(wanted.any(axis=0)).tolist():
            texts = np.flatnonzero(wanted[:, block])
            part = slice(block * BLOCK, (block + 1) * BLOCK)
            cosines[texts, part] = sums[texts, part] + often[texts] @ self.rows[part].T

    def _cells(self, cosines: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The cosines in some blocks of each text."""
        cells = cosines.reshape(len(cosines), self.blocks, BLOCK)
        return np.take_along_axis(cells, blocks[:, :, None], axis=1).reshape(len(cosines), -1)

    def _least(self, cosines: np.ndarray, k: int) -> np.ndarray:
        """Single-precision cosine that an example among the k nearest has at least."""
        if k >= cosines.shape[1]:
            return np.full(len(cosines), -0.5)
        kth = np.partition(cosines, -k, axis=1)[:, -k]
        return np.where(kth > 0, kth - 2 * self.loss - 2e-9, -0.5)

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[float, int]]]:
        """For each (term numbers, weights) the k largest cosines above 0 as (cosine,
        example), to nine places, ties to the smaller example."""
        if self.rows is None:
            self._build()
        often = np.zeros((len(queries), len(self.common)))
        sums = np.zeros((len(queries), self.blocks * BLOCK))
        for i, (numbers, weights) in enumerate(queries):
            column = self.column[numbers]
            rare = column < 0
            often[i, column[~rare]] = weights[~rare]
            at, size = spread(self.begin, numbers[rare])
            found = self.lists[at]
            products = np.repeat(weights[rare], size) * found.view(np.float32)[1::2]
            sums[i] = np.bincount(found.view(np.int32)[::2], products, sums.shape[1])
        single = often.astype(np.float32)
        most = np.minimum(often @ self.most.T, self.length * np.sqrt((often**2).sum(axis=1))[:, None])
        bounds = sums.reshape(len(queries), self.blocks, BLOCK).max(axis=2) + most + self.loss
        best_first = np.argsort(-bounds, axis=1, kind="stable")[:, :VISIT]
        first = np.zeros(bounds.shape, bool)
        np.put_along_axis(first, best_first, True, axis=1)
        cosines = np.full(sums.shape, -1, np.float32)
        self._visit(cosines, sums, single, first)
        least = self._least(self._cells(cosines, best_first), k)
        self._visit(cosines, sums, single, ~first & (bounds >= least[:, None]))
        least = self._least(cosines, k)
        out = []
        for i, row in enumerate(cosines):
            near = np.flatnonzero(row >= least[i])
            exact = sums[i, near] + self.rows[near].astype(float) @ often[i]
            rounded = ((round(c, 9), j) for c, j in zip(exact.tolist(), self.given_number[near].tolist()))
            out.append(sorted((x for x in rounded if x[0] > 0), key=lambda x: (-x[0], x[1]))[:k])
        return out

    def vote(self, best: list[tuple[float, int]]) -> float:
        return sum(c * self.labels[i] for c, i in best) / sum(c for c, _ in best)


def monotone_fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing step heights of y over x (pooling of adjacent violators), smoothed
    by half a positive and half a negative case per step."""
    steps: list[list[float]] = []
    for value in np.unique(x):
        here = y[x == value]
        steps.append([float(here.sum()), float(len(here)), float(value)])
        while len(steps) > 1 and steps[-2][0] / steps[-2][1] >= steps[-1][0] / steps[-1][1]:
            total, count, at = steps.pop()
            steps[-1] = [steps[-1][0] + total, steps[-1][1] + count, at]
    heights = np.array([(s[0] + 0.5) / (s[1] + 1) for s in steps])
    return np.array([s[2] for s in steps]), np.maximum.accumulate(heights)


@dataclass
class ToxicityModel:
    """What scores texts; vocabulary and index lie in a broadcast, read once per process."""

    learned: Broadcast | None
    silent: float
    at: np.ndarray
    heights: np.ndarray

    def score(self, texts: pa.Array) -> tuple[np.ndarray, list[list[int]]]:
        """Score and the neighbours' ids of every text."""
        scores = np.full(len(texts), self.silent)
        evidence: list[list[int]] = [[] for _ in range(len(texts))]
        if self.learned is None:
            return scores, evidence
        vocabulary, index = self.learned.value
        for first, data, bounds in text_chunks(texts):
            vectors = vocabulary.vectors(data, bounds)
            while part := list(islice(vectors, SEARCHED)):
                for (text, *_), best in zip(part, index.nearest([v[1:] for v in part], NEIGHBOURS)):
                    if best:
                        place = min(np.searchsorted(self.at, index.vote(best)), len(self.at) - 1)
                        scores[first + text] = self.heights[place]
                        evidence[first + text] = [int(index.ids[i]) for _, i in best]
        return scores, evidence


def sample_counts(sample: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, label, and the numbers and counts of the terms of every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.zeros(batch.num_rows, np.int64)
            lists = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
            for first, data, bounds in text_chunks(batch.column("text")):
                owners, *columns = vocabulary.counted(data, bounds)
                sizes[first : first + len(bounds) - 1] = np.bincount(owners, minlength=len(bounds) - 1)
                for whole, part in zip(lists, columns):
                    whole.append(part.astype(np.int32))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *lists], ["doc_id", "label", "numbers", "counts"])

    return sample.select("doc_id", "label", "text").mapInArrow(count, "doc_id long, label int, numbers array<int>, counts array<int>")


def learn_toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic") -> ToxicityModel:
    """The model; the driver receives the sample's terms and counts, and broadcasts them."""
    sample = written(labelled_texts(documents, labels, label, FOLDS, HELD_FOLD, SAMPLE_ROWS, salt=8), "toxicity")
    total, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    nothing = ToxicityModel(None, toxic / total if total else 0.0, np.zeros(0), np.zeros(0))
    if not 0 < toxic < total:
        return nothing
    distinct = sample.groupBy("text").agg(F.max("label").alias("label"))
    counts = count_terms(distinct).toArrow()
    if not counts.num_rows:
        return nothing
    hashes = counts.column("term").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes = hashes[order]
    a, n = (counts.column(c).to_numpy().astype(float)[order] for c in ("toxic", "texts"))
    rate, size = distinct.agg(F.avg("label"), F.count("*")).first()
    expected = n * rate
    chi_square = (a - expected) ** 2 * size / (expected * np.maximum(size - n, 0) * (1 - rate) + 1e-9)
    texts = document_frequencies(documents, hashes)
    idf = np.log(1 + texts[-1] / np.maximum(texts[:-1], 1))
    vocabulary = Vocabulary(hashes, idf * np.sqrt((chi_square + 1) / size))
    rows = written(sample_counts(sample, vocabulary), "vectors")
    learned = sample.sparkSession.sparkContext.broadcast((vocabulary, learned_index(rows.where(f"not ({ASIDE})"), vocabulary)))
    told = votes(rows.where(ASIDE), learned).toPandas()
    heard, unheard = told[told["vote"].notna()].sort_values("doc_id"), told[told["vote"].isna()]
    rate = (unheard["label"].sum() + toxic / total) / (len(unheard) + 1)
    at, heights = monotone_fit(np.array([0.0, *heard["vote"], 1.0]), np.array([0.0, *heard["label"], 1.0]))
    return ToxicityModel(learned, rate, at, heights)


#: Sampled texts that are kept aside for calibration.
ASIDE = "pmod(xxhash64(doc_id, 31), 4) = 3"


def learned_index(rows: DataFrame, vocabulary: Vocabulary) -> BlockMaxIndex:
    """The index of the examples, whose terms and counts are bounded by the sample."""
    table = rows.where(F.size("numbers") > 0).orderBy("doc_id").toArrow()
    ids, truth = (table.column(c).to_numpy() for c in ("doc_id", "label"))
    sizes = pc.list_value_length(table.column("numbers")).to_numpy()
    numbers, counts = (pc.list_flatten(table.column(c)).to_numpy() for c in ("numbers", "counts"))
    del table
    weights = np.empty(len(numbers), np.float32)
    end = np.cumsum(sizes)
    for first, last in zip((end - sizes).tolist(), end.tolist()):
        weights[first:last] = vocabulary.unit(numbers[first:last], counts[first:last])
    return BlockMaxIndex(ids, truth, sizes, numbers, weights, len(vocabulary.hashes))


def votes(rows: DataFrame, learned: Broadcast) -> DataFrame:
    """doc_id, label and the neighbours' vote (null without any) of the sample's rows."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, index = learned.value
        for batch in batches:
            found: list[float | None] = []
            for first in range(0, batch.num_rows, SEARCHED):
                part = batch.slice(first, SEARCHED)
                lists = [[np.asarray(x.values) for x in part.column(c)] for c in ("numbers", "counts")]
                asked = [(n, vocabulary.unit(n, c)) for n, c in zip(*lists)]
                found += [index.vote(best) if best else None for best in index.nearest(asked, NEIGHBOURS)]
            columns = [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "vote"])

    return rows.mapInArrow(ask, "doc_id long, label int, vote double")


def toxicity_scores(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score and evidence (ids of the nearest examples) of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, evidence = model.score(batch.column("text"))
            columns = [batch.column("doc_id"), pa.array(scores), pa.array(evidence, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "evidence"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(score, "doc_id long, score double, evidence array<long>")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = learn_toxicity(documents, table(spark, sf_dir, "labels"))
    return toxicity_scores(documents, model).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "evidence",
    )
