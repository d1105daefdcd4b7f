"""Incremental months of a stored model, the history of addresses, and orders against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.columns import DELIVERED
from tradeloom.operators.ranges import as_of
from tradeloom.plans.sales import monthly_revenue
from tradeloom.sources.tables import Tables

MONTH_KEY = "MONTH_KEY"
MONTH_DDL = """
    YEAR int, MONTH int, MONTH_NAME string, MONTH_DATE timestamp_ntz, TOTAL_ORDERS bigint,
    TOTAL_REVENUE double, AVG_ORDER_VALUE double"""
ADDRESS = ["customer_city", "customer_state"]


def month_of_purchase() -> Column:
    """`yyyy-MM` of a raw order's purchase text."""
    return F.substring("order_purchase_timestamp", 1, 7)


def changed_months(orders: DataFrame) -> list[str]:
    """The months raw orders were bought in; as many as the calendar has, at most."""
    return [row[0] for row in orders.select(month_of_purchase()).distinct().collect() if row[0]]


def store_months(t: Tables, path: str, months: list[str] | None = None) -> None:
    """Compute the monthly revenue of some months (default: all) and replace only those.

    Each month is a partition folder. A month without delivered orders loses its
    folder, all others are not touched.
    """
    if months is not None:
        t = t.with_raw(orders=t.orders.where(month_of_purchase().isin(months)))
    rows = monthly_revenue(t).drop("value_sum")
    keyed = rows.withColumn(MONTH_KEY, F.date_format("MONTH_DATE", "yyyy-MM"))
    writer = keyed.repartition(MONTH_KEY).write.mode("overwrite").partitionBy(MONTH_KEY)
    writer.option("partitionOverwriteMode", "static" if months is None else "dynamic").parquet(path)
    if months:
        bought = t.orders.where(F.col("order_status") == DELIVERED)
        left = set(changed_months(bought))
        _drop_months(t.orders.sparkSession, path, [month for month in months if month not in left])


def _drop_months(spark: SparkSession, path: str, months: list[str]) -> None:
    for month in months:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MONTH_KEY}={month}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def open_months(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{MONTH_DDL}, {MONTH_KEY} string").parquet(path).drop(MONTH_KEY)


def first_history(snapshot: DataFrame, moment: str) -> DataFrame:
    """A history that begins with one snapshot of customers."""
    return _single(snapshot).select(
        "customer_id",
        *ADDRESS,
        F.lit(moment).cast("timestamp_ntz").alias("VALID_FROM"),
        F.lit(None).cast("timestamp_ntz").alias("VALID_TO"),
        F.lit(True).alias("IS_CURRENT"),
    )


def _single(snapshot: DataFrame) -> DataFrame:
    """One row per customer; of several addresses the largest counts. No null ids."""
    rows = snapshot.where(F.col("customer_id").isNotNull()).groupBy("customer_id")
    return rows.agg(F.max(F.struct(*ADDRESS)).alias("at")).select("customer_id", "at.*")


def next_history(history: DataFrame, snapshot: DataFrame, moment: str) -> DataFrame:
    """The history after a further snapshot.

    An address that changed or is gone is closed at the moment, a new one opened. Only
    current rows meet the snapshot, in one full outer join on the customer.
    """
    now = F.lit(moment).cast("timestamp_ntz")
    old = history.where("IS_CURRENT").select("customer_id", F.struct(*ADDRESS, "VALID_FROM").alias("old"))
    new = _single(snapshot).select("customer_id", F.struct(*ADDRESS).alias("new"))
    met = old.join(new, "customer_id", "full")
    known, given = F.col("old").isNotNull(), F.col("new").isNotNull()
    same = F.struct("old.customer_city", "old.customer_state").eqNullSafe(F.col("new"))
    stays = known & given & same
    never = F.lit(None).cast("timestamp_ntz")

    def row(kind: str, since: Column, until: Column, current: Column) -> Column:
        return F.struct(
            F.col(f"{kind}.customer_city"),
            F.col(f"{kind}.customer_state"),
            since.alias("VALID_FROM"),
            until.alias("VALID_TO"),
            current.alias("IS_CURRENT"),
        )

    before = F.when(known, row("old", F.col("old.VALID_FROM"), F.when(~stays, now), stays))
    after = F.when(given & ~stays, row("new", now, never, F.lit(True)))
    moved = met.select("customer_id", F.inline(F.array_compact(F.array(before, after))))
    return history.where("not IS_CURRENT").unionByName(moved)


def orders_with_address(orders: DataFrame, history: DataFrame) -> DataFrame:
    """Staged orders with the address their customer had when they bought.

    Nulls where the history does not know the customer yet, or not any more.
    """
    bought = orders.select("ORDER_ID", "CUSTOMER_ID", "ORDER_PURCHASED_AT")
    at = history.withColumnRenamed("customer_id", "CUSTOMER_ID")
    met = as_of(bought, at, "CUSTOMER_ID", "ORDER_PURCHASED_AT", "VALID_FROM", [*ADDRESS, "VALID_FROM", "VALID_TO"])
    valid = F.col("VALID_TO").isNull() | (F.col("ORDER_PURCHASED_AT") < F.col("VALID_TO"))
    kept = [F.when(valid, F.col(c)).alias(name) for c, name in zip([*ADDRESS, "VALID_FROM"], ["CITY", "STATE", "VALID_FROM"])]
    return met.select(*bought.columns, *kept)
