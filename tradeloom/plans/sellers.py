"""Seller models: revenue, lateness, reviews, sellers by state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import (
    ascending,
    descending,
    half_up,
    is_late,
    percent,
    ratio,
)
from tradeloom.operators.rollups import (
    distinct_rollup,
    dual_distinct_rollup,
    mean_of,
    ranked,
    top_with_total,
)
from tradeloom.plans.delivery import days_late
from tradeloom.plans.lines import (
    arrived_orders,
    delivered_seller_items,
    seller_items,
)
from tradeloom.plans.reviews import reviewed_orders, score_mean
from tradeloom.sources.tables import Tables

# Fewest orders of a seller a seller ranking shows.
MIN_SELLER_ORDERS = 30
SELLER = ["seller_id", "CITY", "STATE"]


def top_sellers(t: Tables, limit: int = 20) -> DataFrame:
    """Best sellers by revenue; the share is of all sellers' revenue."""
    return seller_report(seller_totals(t), limit)


def seller_totals(t: Tables) -> DataFrame:
    """Orders, products and prices of every seller; a refresh stores them slice by slice."""

    def build() -> DataFrame:
        rolled = dual_distinct_rollup(
            delivered_seller_items(t),
            SELLER,
            first="order_id",
            second="product_id",
            measures={"price": F.col("price")},
        )
        return rolled.select(*SELLER, "n_order_id", "n_product_id", "price_sum", "price_cnt")

    return t.shared("seller_totals", build)


def seller_report(rolled: DataFrame, limit: int) -> DataFrame:
    """The best of all sellers, given orders, products and prices of each."""
    rolled = rolled.withColumn("TOTAL_REVENUE", half_up(F.col("price_sum"), 2))
    best = top_with_total(
        rolled, metric="TOTAL_REVENUE", total_of="price_sum", tie_break="seller_id",
        limit=limit,
    )
    return best.select(
        F.col("seller_id").alias("SELLER_ID"),
        "CITY",
        "STATE",
        F.col("n_order_id").alias("TOTAL_ORDERS"),
        F.col("n_product_id").alias("UNIQUE_PRODUCTS"),
        "TOTAL_REVENUE",
        half_up(mean_of("price"), 2).alias("AVG_ITEM_PRICE"),
        percent(F.col("price_sum"), F.col("total")).alias("REVENUE_SHARE_PCT"),
    )


def sellers_with_highest_delay(t: Tables, limit: int | None = 20) -> DataFrame:
    """Late share per seller; mean days late over the late item rows."""
    arrived = arrived_orders(t, "estimated_at").select(
        "order_id",
        is_late().alias("late"),
        F.when(is_late(), days_late()).alias("days"),
    )
    rolled = distinct_rollup(
        seller_items(t).join(arrived, "order_id"),
        SELLER,
        "order_id",
        flags={"late": F.col("late")},
        measures={"days": F.col("days")},
    )
    report = rolled.where(F.col("n") >= MIN_SELLER_ORDERS).select(
        F.col("seller_id").alias("SELLER_ID"),
        "CITY",
        "STATE",
        F.col("n").alias("TOTAL_ORDERS"),
        F.col("n_late").alias("LATE_ORDERS"),
        percent(F.col("n_late"), F.col("n")).alias("LATE_RATE_PCT"),
        half_up(mean_of("days"), 1).alias("AVG_DAYS_LATE"),
    )
    return ranked(report, [descending("LATE_RATE_PCT"), ascending("SELLER_ID")], limit)


def sellers_best_reviews(t: Tables, limit: int | None = 20) -> DataFrame:
    """Best reviewed sellers; scores weigh once per item row of the order."""
    rolled = distinct_rollup(
        reviewed_orders(t, delivered_seller_items(t), *SELLER),
        SELLER,
        "order_id",
        flags={name: F.col(name) for name in ("five", "one", "positive")},
        measures={name: F.col(name) for name in ("score_total", "score_count")},
    )
    report = rolled.where(F.col("n") >= MIN_SELLER_ORDERS).select(
        F.col("seller_id").alias("SELLER_ID"),
        "CITY",
        "STATE",
        F.col("n").alias("TOTAL_ORDERS"),
        half_up(score_mean(), 2).alias("AVG_REVIEW_SCORE"),
        F.col("n_five").alias("FIVE_STAR_ORDERS"),
        F.col("n_one").alias("ONE_STAR_ORDERS"),
        percent(F.col("n_positive"), F.col("n")).alias("POSITIVE_RATE_PCT"),
    )
    return ranked(report, [descending("AVG_REVIEW_SCORE"), ascending("SELLER_ID")], limit)


def active_sellers_by_state(t: Tables) -> DataFrame:
    """Sellers with delivered items, their orders and revenue by seller state."""
    rolled = dual_distinct_rollup(
        delivered_seller_items(t),
        ["STATE"],
        first="order_id",
        second="seller_id",
        measures={"price": F.col("price")},
    )
    per_seller = ratio(F.col("n_order_id"), F.col("n_seller_id"))
    report = rolled.select(
        "STATE",
        F.col("n_seller_id").alias("ACTIVE_SELLERS"),
        F.col("n_order_id").alias("TOTAL_ORDERS"),
        half_up(F.col("price_sum"), 2).alias("TOTAL_REVENUE"),
        half_up(mean_of("price"), 2).alias("AVG_ITEM_PRICE"),
        half_up(per_seller, 1).alias("ORDERS_PER_SELLER"),
    )
    return ranked(report, [descending("ACTIVE_SELLERS"), ascending("STATE")])
