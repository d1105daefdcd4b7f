"""Staging: typed orders with derived calendar columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import hour_start, month_start, weekday_number

# Staged column -> raw text column it is parsed from.
PARSED_FROM = {
    "ORDER_PURCHASED_AT": "order_purchase_timestamp",
    "ORDER_APPROVED_AT": "order_approved_at",
    "ORDER_SHIPPED_AT": "order_delivered_carrier_date",
    "ORDER_DELIVERED_AT": "order_delivered_customer_date",
    "ORDER_ESTIMATED_AT": "order_estimated_delivery_date",
}

# Staged column -> short name used inside the models.
SHORT_NAMES = {
    "ORDER_ID": "order_id",
    "CUSTOMER_ID": "customer_id",
    "ORDER_STATUS": "status",
    "ORDER_PURCHASED_AT": "purchased_at",
    "ORDER_DELIVERED_AT": "delivered_at",
    "ORDER_ESTIMATED_AT": "estimated_at",
    "ORDER_MONTH": "order_month",
    "ORDER_DAY_OF_WEEK": "weekday",
    "ORDER_HOUR_OF_DAY": "hour_of_day",
}


def _parse(text: Column, strict: bool) -> Column:
    if strict:
        return F.to_timestamp_ntz(text)
    return text.try_cast("timestamp_ntz")


def stage_orders(raw_orders: DataFrame, strict: bool = True) -> DataFrame:
    """Type the raw orders; one row in, one row out.

    `strict` fails the job on malformed timestamp text; otherwise such text
    becomes null and the row can be routed aside.
    """
    parsed = raw_orders.select(
        F.col("order_id").alias("ORDER_ID"),
        F.col("customer_id").alias("CUSTOMER_ID"),
        F.col("order_status").alias("ORDER_STATUS"),
        *[_parse(F.col(raw), strict).alias(name) for name, raw in PARSED_FROM.items()],
    )
    bought = F.col("ORDER_PURCHASED_AT")
    return parsed.select(
        "*",
        month_start(bought).alias("ORDER_MONTH"),
        hour_start(bought).alias("ORDER_HOUR"),
        weekday_number(bought).alias("ORDER_DAY_OF_WEEK"),
        F.hour(bought).alias("ORDER_HOUR_OF_DAY"),
    )


# Timestamp texts that models parse, by raw table.
PARSED_TEXTS = {
    "orders": list(PARSED_FROM.values()),
    "order_reviews": ["review_creation_date", "review_answer_timestamp"],
}


def is_malformed(table: str) -> Column:
    """Whether any timestamp text of a raw row is present but unreadable."""
    unreadable = [
        F.col(raw).isNotNull() & F.col(raw).try_cast("timestamp_ntz").isNull()
        for raw in PARSED_TEXTS[table]
    ]
    return reduce(Column.__or__, unreadable)


def orders_view(staged: DataFrame) -> DataFrame:
    """The columns the models use, under short names."""
    return staged.select(
        *[F.col(name).alias(short) for name, short in SHORT_NAMES.items()]
    )
