"""Loading on arrival: new files of raw orders are staged once each, and counted by day.

Every run handles what has arrived since the last one and ends; what was handled is kept
in the checkpoint folder, so a run that was cut off goes on where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions.columns import DELIVERED
from tradeloom.operators.staging import stage_orders
from tradeloom.schemas import contract, raw_schema
from tradeloom.streaming.revenue import moment, once, store_batch

DAYS_DDL = "ORDER_DATE timestamp_ntz, TOTAL_ORDERS bigint, DELIVERED_ORDERS bigint"


def arriving_orders(spark: SparkSession, incoming: str) -> DataFrame:
    """Staged orders of the files in a folder, as a stream."""
    return stage_orders(spark.readStream.schema(raw_schema("orders")).parquet(incoming))


def load_arrivals(spark: SparkSession, incoming: str, target: str, checkpoint: str, late: str | None = None) -> None:
    """Append the staged orders of new files to the target table.

    With `late`, for how long an order may come after later ones, an order that is delivered
    again is dropped by keyed state; orders without purchase moment or later than that are
    dropped as well. A target and its checkpoint keep to one of both ways.
    """
    rows = spark.readStream.schema(raw_schema("orders")).parquet(incoming)
    if late:
        rows = once(rows.withColumn("at", moment("order_purchase_timestamp")), "at", ["order_id"], late).drop("at")
    writer = stage_orders(rows).writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).option("path", target)
    writer.trigger(availableNow=True).start().awaitTermination()


def count_arrivals(spark: SparkSession, incoming: str, target: str, checkpoint: str) -> None:
    """Keep orders per day of purchase up to date; the state has one row per day."""
    day = F.window("ORDER_PURCHASED_AT", "1 day")
    counted = (
        arriving_orders(spark, incoming)
        .groupBy(day.alias("day"))
        .agg(
            F.count("ORDER_ID").alias("TOTAL_ORDERS"),
            F.count_if(F.col("ORDER_STATUS") == DELIVERED).alias("DELIVERED_ORDERS"),
        )
        .select(F.col("day.start").alias("ORDER_DATE"), "TOTAL_ORDERS", "DELIVERED_ORDERS")
    )

    # Each batch has all days, in a folder of its own: readers keep the last finished one.
    writer = counted.writeStream.outputMode("complete").foreachBatch(lambda rows, batch: store_batch(rows, batch, target))
    writer = writer.option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def loaded_orders(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(contract("stg_orders")).parquet(target)


def counted_days(spark: SparkSession, target: str) -> DataFrame:
    """The days of the batch finished last; the number of a batch is read from folder names."""
    rows = spark.read.schema(f"{DAYS_DDL}, batch long").parquet(target)
    last = rows.agg(F.max("batch")).first()[0]
    return rows.where(F.col("batch") == F.lit(last)).drop("batch")
