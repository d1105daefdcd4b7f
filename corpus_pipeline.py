"""From raw documents to packed training sequences, stage by stage.

Each stage gets the session, the documents its predecessor kept (as read from Parquet) and
the folder of the tables. All stages but the last return the columns of their input:

1. quality: documents the classifier rejects go;
2. near_copies: one document of each group of near copies stays;
3. repeats: passages of REPEATED_BYTES or more that occur elsewhere are cut out of the texts
   (whole characters only), the documents stay;
4. secrets: found secrets are masked in the texts, the documents stay;
5. packing: the pieces of all documents in sequences of at most 2048 tokens.

A null text counts as empty and stays null. An empty table passes all stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm.bpe import VOCABULARY
from tradeloom.llm.near_copies import keep_first_copies
from tradeloom.llm.packing import pack_documents
from tradeloom.llm.quality import keep_good, learn_quality
from tradeloom.llm.repeats import drop_repeats
from tradeloom.llm.secrets import learn_secrets, mask_secrets
from tradeloom.llm.tables import table, written


#: Bytes from which on a passage that occurs elsewhere is cut out: 51 words of 3.7 letters on
#: average with the sign behind each. Passages of as many but shorter words stay.
REPEATED_BYTES = 240


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, learn_quality(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first_copies(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeats(docs, REPEATED_BYTES)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_secrets(docs, learn_secrets(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeats", repeats),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL cannot express the classifiers and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = written(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
