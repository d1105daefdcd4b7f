"""Aggregation shapes shared by the models.

Exact distinct counts are computed in two grouping steps instead of with several
`count_distinct` calls, which would multiply every input row before the shuffle.
The first step groups on (keys, entity); after a join on the entity it needs no
shuffle of its own. The second step groups on the keys and starts with a partial
aggregation in every task, so one key with a large part of all rows is reduced
where the rows are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.columns import ascending, descending, ratio
from tradeloom.functions.money import exact_sum, joined, rest_part, total_over, whole_part


def mean_of(name: str) -> Column:
    """Mean of a measure that was carried as `<name>_sum` and `<name>_cnt`."""
    return ratio(F.col(f"{name}_sum"), F.col(f"{name}_cnt"))


def _measure_columns(measures: Mapping[str, Column]) -> list[Column]:
    """Partial statistics of each measure; unused ones are pruned by Catalyst."""
    return [
        stat(value).alias(f"{name}_{suffix}")
        for name, value in measures.items()
        for suffix, stat in (
            ("whole", lambda value: F.sum(whole_part(value))),
            ("rest", lambda value: F.sum(rest_part(value))),
            ("cnt", F.count),
            ("min", F.min),
            ("max", F.max),
        )
    ]


def _merged_columns(measures: Mapping[str, Column]) -> list[Column]:
    """Merge the partial statistics of a former step."""
    return [
        merge(f"{name}_{suffix}").alias(f"{name}_{suffix}")
        for name in measures
        for suffix, merge in (
            ("whole", F.sum),
            ("rest", F.sum),
            ("cnt", F.sum),
            ("min", F.min),
            ("max", F.max),
        )
    ]


def _with_sums(merged: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """`<name>_sum` from the sums of whole parts and rests, which any order gives alike."""
    sums = {f"{m}_whole": joined(F.col(f"{m}_whole"), F.col(f"{m}_rest")).cast("double").alias(f"{m}_sum") for m in measures}
    rests = {f"{m}_rest" for m in measures}
    return merged.select(*[sums.get(c, F.col(c)) for c in merged.columns if c not in rests])


def distinct_rollup(
    df: DataFrame,
    keys: Sequence[str],
    entity: str,
    flags: Mapping[str, Column] | None = None,
    measures: Mapping[str, Column] | None = None,
    once: Mapping[str, Column] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Per key: distinct entities, distinct flagged entities, row statistics.

    Returns the keys, `n` (distinct non-null entities), one `n_<flag>` per flag
    (distinct entities with at least one row where it holds) and
    `<measure>_sum/_cnt/_min/_max` over all rows. A value of `once` is the same on all
    rows of an entity; `<name>_once` adds it up over entities.

    `unique`: every entity is known to have one row. Then rows are counted in place and
    only one partial result per key and task is shuffled.
    """
    flags, measures, once = dict(flags or {}), dict(measures or {}), dict(once or {})
    known = F.col(entity).isNotNull()
    if unique:
        counted = df.groupBy(*keys).agg(
            F.count(entity).alias("n"),
            *[F.count_if(known & holds).alias(f"n_{name}") for name, holds in flags.items()],
            *[F.sum(value).alias(f"{name}_once") for name, value in once.items()],
            *_measure_columns(measures),
        )
        return _with_sums(counted, measures)
    per_entity = df.groupBy(*keys, entity).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.max(holds).alias(f"has_{name}") for name, holds in flags.items()],
        *[F.max(value).alias(f"once_{name}") for name, value in once.items()],
        *_measure_columns(measures),
    )
    counted = per_entity.groupBy(*keys).agg(
        F.count(entity).alias("n"),
        *[F.count_if(known & F.col(f"has_{f}")).alias(f"n_{f}") for f in flags],
        *[F.sum(f"once_{name}").alias(f"{name}_once") for name in once],
        *_merged_columns(measures),
    )
    return _with_sums(counted, measures)


def dual_distinct_rollup(
    df: DataFrame,
    keys: Sequence[str],
    first: str,
    second: str,
    measures: Mapping[str, Column],
) -> DataFrame:
    """Per key: distinct `first` and distinct `second`, both counted exactly.

    `first` is the column the input is already partitioned on (the join key): its
    duplicates within a key are marked without a shuffle. Grouping on
    (keys, second) then sums the marks, and grouping on the keys counts the rows.
    A null counts as neither, its row still counts in the measures.

    Returns the keys, `n_<first>`, `n_<second>` and the measure statistics.
    """
    cells = df.groupBy(first, *keys, second).agg(*_measure_columns(measures))
    within = Window.partitionBy(first, *keys).orderBy(second)
    marked = cells.withColumn(
        "opens", ((F.row_number().over(within) == 1) & F.col(first).isNotNull()).cast("int")
    )
    per_second = marked.groupBy(*keys, second).agg(
        F.sum("opens").alias("opens"), *_merged_columns(measures)
    )
    counted = per_second.groupBy(*keys).agg(
        F.sum("opens").alias(f"n_{first}"),
        F.count(second).alias(f"n_{second}"),
        *_merged_columns(measures),
    )
    return _with_sums(counted, measures)


def group_total(metric: str, *part: str) -> Column:
    """Total of a metric over all groups, or over the groups of one part.

    Only for frames that hold one row per value of a small domain (months,
    weekday hours, states, categories): the rows of a part meet in one task.
    """
    return total_over(F.col(metric), *part)


def top_with_total(
    df: DataFrame, metric: str, total_of: str, tie_break: str, limit: int
) -> DataFrame:
    """The `limit` rows with the largest metric, plus a total over all rows.

    For frames of unbounded size. Rows are spread over as many hash buckets as a shuffle
    has partitions; each bucket keeps its `limit` best rows and its sum, and the last step
    sees those only. The input is computed once (a scalar subquery for the total reads
    fewer columns, so that its exchange is not shared).
    """
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_rank = (descending(metric), ascending(tie_break))
    in_bucket = Window.partitionBy("bucket")
    finalists = (
        df.withColumn("bucket", F.pmod(F.xxhash64(tie_break), F.lit(buckets)))
        .withColumn("bucket_total", exact_sum(F.col(total_of), in_bucket))
        .withColumn("place", F.row_number().over(in_bucket.orderBy(*by_rank)))
        .where(F.col("place") <= limit)
    )
    one_per_bucket = F.when(F.col("place") == 1, F.col("bucket_total"))
    return (
        finalists.withColumn("total", exact_sum(one_per_bucket, Window.partitionBy()))
        .orderBy(*by_rank)
        .limit(limit)
        .drop("bucket", "bucket_total", "place")
    )


def ranked(
    df: DataFrame, by: Sequence[Column], limit: int | None = None
) -> DataFrame:
    """Sorted report; with a limit Spark keeps only the best rows per task."""
    ordered = df.orderBy(*by)
    return ordered if limit is None else ordered.limit(limit)
