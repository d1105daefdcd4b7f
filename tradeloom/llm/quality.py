"""Document quality: hashed word n-grams, logistic regression, FTRL updates.

Words are runs of letters and digits or runs of other signs, ASCII lower-cased. Features
are hashed words, hashed pairs of neighbouring words and one feature for a pair of equal
words; each occurrence has the value 1 / sqrt(number of occurrences). Every shard of a
bounded labelled sample is learned by follow-the-regularised-leader updates in a task of
its own, and the shards' weights are averaged. A score is the logistic function of a
sparse dot product.

A null or empty text has no features and gets the score of the bias alone. Without any
labelled row all scores are 0.5. Repeated rows are scored alike and all returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.tables import fold, labelled_texts, table
from tradeloom.llm.words import CLASSES, LOWER, RangeHash, mix, text_chunks, token_bounds

FOLDS, HELD_FOLD = 3, 1
#: Labelled documents learned from, dealt over shards.
SAMPLE_ROWS = 20_000
SHARDS = 16
#: Feature space: the bias, the equal pair, and hash buckets.
BUCKETS = 1 << 18
BIAS, EQUAL_PAIR, FIRST_BUCKET = 0, 1, 2
#: FTRL: step size, its offset, and both penalties; passes over a shard.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.05, 0.1, 4


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-gram occurrences, text by text, and where each text's begin."""
    lowered = LOWER[data]
    starts, ends, text = token_bounds(lowered, bounds, CLASSES)
    word = RangeHash(lowered)(starts, ends)
    same_text = text[1:] == text[:-1]
    pair = mix(word[:-1] * np.uint64(3) + word[1:])
    space = np.uint64(BUCKETS - FIRST_BUCKET)
    pair_bucket = np.where(word[:-1] == word[1:], EQUAL_PAIR, (pair % space).astype(np.int64) + FIRST_BUCKET)[same_text]
    bucket = np.concatenate([(word % space).astype(np.int64) + FIRST_BUCKET, pair_bucket])
    owner = np.concatenate([text, text[1:][same_text]])
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(bounds) - 1)
    return bucket[order], np.concatenate([[0], np.cumsum(counts)])


def dot_products(weights: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    bucket, begin = features(data, bounds)
    sums = np.concatenate([[0.0], np.cumsum(weights[bucket])])
    counts = np.diff(begin)
    return weights[BIAS] + (sums[begin[1:]] - sums[begin[:-1]]) / np.sqrt(np.maximum(counts, 1))


def logistic(values: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(values, -35, 35)))


def ftrl_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """Non-zero weights learned from one shard of labelled texts."""
    rows = rows.sort_values(["doc_id", "text"])
    columns = []
    for _, data, bounds in text_chunks(pa.array(rows["text"], pa.large_string())):
        bucket, begin = features(data, bounds)
        for a, b in zip(begin[:-1], begin[1:]):
            where, count = np.unique(bucket[a:b], return_counts=True)
            columns.append((np.append(where, BIAS), np.append(count / np.sqrt(max(1, b - a)), 1.0)))
    z, n = np.zeros(BUCKETS), np.zeros(BUCKETS)
    labels = rows["label"].to_numpy()

    def weights(at: np.ndarray | slice) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(columns)):
            at, x = columns[i]
            w = weights(at)
            g = (logistic(w @ x) - labels[i]) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(slice(None))
    kept = np.flatnonzero(w)
    return pd.DataFrame({"bucket": kept, "weight": w[kept]})


def learn_quality(documents: DataFrame, labels: DataFrame, label: str = "quality") -> np.ndarray:
    """One weight per bucket; the driver receives BUCKETS numbers at most."""
    sample = labelled_texts(documents, labels, label, FOLDS, HELD_FOLD, SAMPLE_ROWS, salt=1)
    shards = sample.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(SHARDS)))
    learned = (
        shards.groupBy("shard")
        .applyInPandas(lambda rows: ftrl_shard(rows), "bucket int, weight double")
        .groupBy("bucket")
        .agg((F.sum("weight") / SHARDS).alias("weight"))
        .toPandas()
    )
    weights = np.zeros(BUCKETS)
    weights[learned["bucket"].to_numpy(int)] = learned["weight"]
    return weights


def batch_scores(weights: np.ndarray, texts: pa.Array) -> np.ndarray:
    found = [logistic(dot_products(weights, data, bounds)) for _, data, bounds in text_chunks(texts)]
    return np.concatenate(found) if found else np.zeros(0)


def quality_scores(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch_scores(weights, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")


def keep_good(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """The documents, all columns, whose score is 0.5 or more."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(batch_scores(weights, batch.column("text")) >= 0.5))

    return documents.mapInArrow(keep, documents.schema)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    weights = learn_quality(documents, table(spark, sf_dir, "labels"))
    return quality_scores(documents, weights).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
