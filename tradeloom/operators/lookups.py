"""Joins of a fact with a dimension, broadcast only after a check of its size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def input_bytes(df: DataFrame) -> int:
    """Bytes of all inputs a frame reads, as Spark knows them while planning.

    A dimension made by key lookups has no more rows than its inputs, so this
    bounds its size. (Spark's own estimate of a join is the product of both sides,
    far too large for a lookup.) Inputs of unknown size count as unbounded.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size()))
    return sum(int(str(size)) for size in sizes)


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes; -1 switches broadcasts off."""
    state = df.sparkSession._jsparkSession.sessionState()
    return state.conf().autoBroadcastJoinThreshold()


def counted_bytes(df: DataFrame) -> int:
    """Bytes of a frame's values as text, by one aggregation over it."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns]
    return df.agg(F.coalesce(F.sum(sum(widths[1:], widths[0])), F.lit(0))).first()[0]


def lookup_join(
    fact: DataFrame, dimension: DataFrame, key: str, how: str = "inner", derived: bool = False
) -> DataFrame:
    """Join on a dimension key without moving the fact when the dimension is small.

    Up to the session's broadcast threshold the dimension is broadcast. Beyond it
    both sides are shuffled, and skewed fact partitions are split at run time. A
    `derived` dimension may be far smaller than its inputs (distinct values of a large
    table), so where those are too large its own size is measured first.
    """
    limit = broadcast_limit(dimension)
    if input_bytes(dimension) <= limit or (derived and limit > 0 and counted_bytes(dimension) <= limit):
        dimension = F.broadcast(dimension)
    return fact.join(dimension, key, how)
