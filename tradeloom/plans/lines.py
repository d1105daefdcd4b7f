"""Shared starting points of the models.

Order of joins: a fact first takes on the attributes of its dimensions, and the
join on the order key comes last. The grouping on (keys, order) that follows then
runs in the partitioning of that join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import DELIVERED, category_label
from tradeloom.operators.lookups import lookup_join
from tradeloom.sources.tables import Tables


def delivered_orders(t: Tables) -> DataFrame:
    return t.placed_orders.where(F.col("status") == DELIVERED)


def arrived_orders(t: Tables, compare_with: str) -> DataFrame:
    """Delivered orders with a delivery moment and a moment to compare it with."""
    return delivered_orders(t).where(
        F.col("delivered_at").isNotNull() & F.col(compare_with).isNotNull()
    )


def labelled_products(t: Tables) -> DataFrame:
    """product_id and CATEGORY of every product."""
    named = lookup_join(
        t.products, t.translation, "product_category_name", "left", derived=True
    )
    return named.select(
        "product_id",
        category_label(
            F.col("product_category_name_english"), F.col("product_category_name")
        ).alias("CATEGORY"),
    )


def categorised_items(t: Tables) -> DataFrame:
    """One row per item of a known product: order_id, product_id, price, CATEGORY."""
    items = t.order_items.select("order_id", "product_id", "price")
    return lookup_join(items, labelled_products(t), "product_id")


def seller_items(t: Tables) -> DataFrame:
    """One row per item of a known seller, with the seller's place."""
    items = t.order_items.select("order_id", "product_id", "seller_id", "price")
    places = t.sellers.select(
        "seller_id",
        F.col("seller_city").alias("CITY"),
        F.col("seller_state").alias("STATE"),
    )
    return lookup_join(items, places, "seller_id")


def sales_lines(t: Tables) -> DataFrame:
    """Items of delivered orders with CATEGORY and the order's moments.

    Seven models start here; a refresh stores it once for all of them.
    """
    moments = ["purchased_at", "delivered_at", "estimated_at"]

    def build() -> DataFrame:
        orders = delivered_orders(t).select("order_id", *moments)
        joined = categorised_items(t).join(orders, "order_id")
        return joined.select("order_id", "product_id", "CATEGORY", "price", *moments)

    return t.shared("sales_lines", build)


def paid_lines(t: Tables) -> DataFrame:
    """Payments of delivered orders with customer and purchase moment, shared alike."""

    def build() -> DataFrame:
        orders = delivered_orders(t).select("order_id", "customer_id", "purchased_at")
        payments = t.order_payments.select("order_id", "payment_type", "payment_value")
        return payments.join(orders, "order_id")

    return t.shared("paid_lines", build)


#: Shared lines with the key whose slices make them up.
SHARED_LINES = {"sales_lines": (sales_lines, "order_id"), "paid_lines": (paid_lines, "order_id")}


def delivered_seller_items(t: Tables) -> DataFrame:
    """Items of delivered orders with the seller's place."""
    return seller_items(t).join(delivered_orders(t).select("order_id"), "order_id")


def lines_per_order(lines: DataFrame, *keys: str) -> DataFrame:
    """How many item rows (`weight`) an order has per key.

    Pairing payments or reviews with every item of an order repeats their values
    `weight` times. Carrying the weight gives the same averages without emitting
    the pairs. After the join on the order id this grouping, and a further join on
    the order id, stay in place.
    """
    return lines.groupBy("order_id", *keys).agg(F.count(F.lit(1)).alias("weight"))


def weighted(name: str) -> list[Column]:
    """`<name>_total` and `<name>_count`: an order's sum and count times its weight."""
    weight = F.col("weight")
    return [
        (F.col(f"{name}_sum") * weight).alias(f"{name}_total"),
        (F.col(f"{name}_cnt") * weight).alias(f"{name}_count"),
    ]
