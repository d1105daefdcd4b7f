"""Reading tables, written intermediate results and bounded labelled samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.session import new_run_folder

#: Buckets of the hash that picks samples.
SAMPLE_BUCKETS = 1 << 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as Parquet files in the shared folder, which cuts its lineage."""
    spark = frame.sparkSession
    path = new_run_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def bounded_sample(rows: DataFrame, key: str, most: int, salt: int, count: int | None = None) -> DataFrame:
    """About `most` rows, or all if there are fewer, picked by a hash of their key.

    With `count`, the number of distinct keys, about `most` keys with all of their rows.

    Needs one count and no shuffle: the same filter works at any size.
    """
    share = min(1.0, most / max(1, rows.count() if count is None else count))
    place = F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(SAMPLE_BUCKETS))
    return rows.where(place < int(share * SAMPLE_BUCKETS))


def labelled_texts(documents: DataFrame, labels: DataFrame, label: str, folds: int, held: int, most: int, salt: int) -> DataFrame:
    """doc_id, text and label of about `most` labelled documents outside the held fold.

    Labels other than 0 and 1 and null ids are left out; a repeated id counts once, with
    its larger label and its smaller text. The sampled ids are broadcast: `most` of them.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    chosen = bounded_sample(known, "doc_id", most, salt)
    return (
        documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("label").alias("label"))
    )


def free_name(frame: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column of the frame begins like it."""
    taken = [c.lower() for c in frame.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name = f"_{name}"
    return name
