"""Running totals, neighbours and as-of joins over an order that no task can hold.

Rows are dealt to ranges of the order, as many as a shuffle has partitions, and written
once, so that their ranges stay the same. Each range is then scanned by itself; what goes
on across a border (a sum, a last row) is one row per range, and only those rows meet in
one task. A value with very many rows of its own is spread like any other, as long as the
order tells its rows apart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tradeloom.session import new_run_folder

RANGE, PLACE = "_range", "_place"


def _before() -> WindowSpec:
    """The ranges ahead of one, in a frame of one row per range."""
    return Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)


def in_ranges(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows with `_range`, numbered in the order given, and `_place` within it."""
    spark = rows.sparkSession
    path = new_run_folder(spark, "ranges")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, *order).withColumn(RANGE, F.spark_partition_id())
    dealt.write.parquet(path)
    stored = spark.read.schema(dealt.schema).parquet(path)
    return stored.withColumn(PLACE, F.row_number().over(Window.partitionBy(RANGE).orderBy(*order)))


def _per_range(dealt: DataFrame, found: DataFrame) -> DataFrame:
    """Give each row what was found for its range: as many rows as there are ranges."""
    return dealt.join(F.broadcast(found), RANGE, "left")


def running_totals(rows: DataFrame, order: Sequence[Column], measures: Mapping[str, Column]) -> DataFrame:
    """The rows with `<name>_so_far` and `<name>_whole` of every measure.

    The sum up to each row, itself included, and that of all rows; nulls count as nothing.
    Equal rows of the order follow each other in any order, so it should tell rows apart.
    Decimal measures are exact; sums of doubles depend on how rows were dealt.
    """
    named = {f"_{name}": value for name, value in measures.items()}
    dealt = in_ranges(rows.withColumns(named), order)
    sums = dealt.groupBy(RANGE).agg(*[F.sum(name).alias(f"{name}_in") for name in named])
    everywhere = Window.partitionBy()
    found = sums.select(
        RANGE,
        *[F.sum(f"{name}_in").over(_before()).alias(f"{name}_before") for name in named],
        *[F.sum(f"{name}_in").over(everywhere).alias(f"{name}_all") for name in named],
    )
    local = Window.partitionBy(RANGE).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0)
    added = [
        column
        for name in named
        for column in (
            (F.coalesce(f"{name}_before", zero) + F.coalesce(F.sum(name).over(local), zero)).alias(f"{name[1:]}_so_far"),
            F.coalesce(f"{name}_all", zero).alias(f"{name[1:]}_whole"),
        )
    ]
    return _per_range(dealt, found).select(*rows.columns, *added)


def with_previous(rows: DataFrame, order: Sequence[Column], column: str, alias: str) -> DataFrame:
    """The rows with a column of the row before, null for the first."""
    dealt = in_ranges(rows, order)
    last = dealt.groupBy(RANGE).agg(F.max_by(F.struct(column), PLACE).alias("last"))
    border = last.select(RANGE, F.lag("last").over(Window.orderBy(RANGE)).alias("border"))
    inside = F.lag(column).over(Window.partitionBy(RANGE).orderBy(PLACE))
    value = F.when(F.col(PLACE) == 1, F.col(f"border.{column}")).otherwise(inside)
    return _per_range(dealt, border).select(*rows.columns, value.alias(alias))


def as_of(facts: DataFrame, history: DataFrame, key: str, moment: str, since: str, values: Sequence[str]) -> DataFrame:
    """The facts with `values` of the last history row of their key up to their moment.

    A row of the same moment counts; of several with one moment the largest values count.
    Facts without key, moment or earlier row get nulls; none is lost or repeated. Facts and
    history are put in one order of key and moment and scanned once: no pairs are made, and
    a key with most of the rows is spread over as many ranges as it fills.
    """
    known = F.struct(*values)
    past = history.where(F.col(key).isNotNull() & F.col(since).isNotNull())
    past = past.groupBy(F.col(key).alias("_key"), F.col(since).alias("_at")).agg(F.max(known).alias("_known"))
    fact = F.struct(*facts.columns)
    ordered = F.col(key).isNotNull() & F.col(moment).isNotNull()
    now = facts.where(ordered).select(F.col(key).alias("_key"), F.col(moment).alias("_at"), fact.alias("_fact"))
    events = now.withColumn("_salt", F.xxhash64("_fact")).unionByName(past, allowMissingColumns=True)
    events = events.withColumn("_kind", F.col("_fact").isNotNull())
    order = [F.col("_key"), F.col("_at"), F.col("_kind"), F.col("_salt")]
    dealt = in_ranges(events, order)
    last = dealt.where("not _kind").groupBy(RANGE).agg(F.max_by(F.struct("_key", "_known"), PLACE).alias("last"))
    every = dealt.select(RANGE).distinct().join(last, RANGE, "left")
    border = every.select(RANGE, F.last("last", ignorenulls=True).over(_before()).alias("border"))
    local = Window.partitionBy(RANGE, "_key").orderBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = F.last("_known", ignorenulls=True).over(local)
    carried = F.when(F.col("border._key") == F.col("_key"), F.col("border._known"))
    met = _per_range(dealt, border).withColumn("_found", F.coalesce(inside, carried)).where("_kind")
    told = met.select("_fact.*", *[F.col(f"_found.{v}").alias(v) for v in values])
    return told.unionByName(facts.where(~ordered), allowMissingColumns=True)
