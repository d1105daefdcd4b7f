"""Block grid for searches of a stated query set against all vectors, and its merge.

Vectors are dealt over row blocks, queries over query blocks, and every cell of the grid
is one task of bounded size. A row goes once to each query block, a query once to each
row block. Rows are dealt by their place in the input, so repeated ids spread as well.

Vectors that are null, or hold null or non-finite components, or whose length is not the
most frequent one (the shorter of two as frequent), take no part; nor does a null id. Rows
with a repeated id are candidates of their own; as a query such an id is asked once, with
its smallest vector, and its own id is never among its answers.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Most vectors of a row block and of a query block, and the least number of row blocks.
BLOCK_ROWS, BLOCK_QUERIES, LEAST_BLOCKS = 16_384, 1024, 24
#: Queries are the rows whose id is divisible by this.
QUERY_STEP = 100


def usable(embeddings: DataFrame, keep_zero: bool) -> tuple[DataFrame, int]:
    """vec_id and vector (doubles) of the rows that take part, and their number."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite)
    if not keep_zero:
        rows = rows.where(F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return rows, 0
    return rows.where(F.size("embedding") == sizes["size"]), sizes["count"]


def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if rows else pa.array([], pa.float64())
    return np.asarray(flat).reshape(rows, -1)


def search_grid(
    embeddings: DataFrame,
    kernel: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray]],
    score_type: str,
    best_last: bool,
    k: int,
    keep_zero: bool,
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best, by a kernel per grid cell.

    The kernel gets query ids, queries, row ids, rows and k, and returns query ids, row
    ids and scores, at most k for each query. `best_last`: larger scores are better.
    """
    rows, count = usable(embeddings, keep_zero)
    blocks = max(LEAST_BLOCKS, -(-count // BLOCK_ROWS))
    asked = rows.where(F.col("vec_id") % QUERY_STEP == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    query_blocks = max(1, -(-count // (QUERY_STEP * BLOCK_QUERIES)) * 2 - 1)
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    left = rows.withColumn("block", place).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def cell(row_table: pa.Table, query_table: pa.Table) -> pa.Table:
        n, q = row_table.num_rows, query_table.num_rows
        found = ([], [], [])
        if n and q:
            found = kernel(
                query_table.column("vec_id").to_numpy(), matrix(query_table.column("embedding"), q),
                row_table.column("vec_id").to_numpy(), matrix(row_table.column("embedding"), n), k,
            )
        types = (pa.int64(), pa.int64(), pa.int64() if score_type == "long" else pa.float64())
        return pa.table([pa.array(x, t) for x, t in zip(found, types)], ["query_id", "vec_id", "score"])

    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(
        cell, f"query_id long, vec_id long, score {score_type}"
    )
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score") if best_last else F.asc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
