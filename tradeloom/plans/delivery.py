"""Delivery models: duration, lateness, and lateness against review score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import (
    ascending,
    days_between,
    descending,
    half_up,
    is_late,
    month_start,
    percent,
)
from tradeloom.operators.lookups import lookup_join
from tradeloom.operators.rollups import distinct_rollup, mean_of, ranked
from tradeloom.plans.customers import customer_places
from tradeloom.plans.lines import arrived_orders, sales_lines
from tradeloom.plans.sales import MIN_CATEGORY_ORDERS
from tradeloom.sources.tables import Tables


def days_late() -> Column:
    """Days past the promise; negative when early."""
    return days_between(F.col("estimated_at"), F.col("delivered_at"))


def days_to_deliver() -> Column:
    return days_between(F.col("purchased_at"), F.col("delivered_at"))


def delivery_time_by_state(t: Tables) -> DataFrame:
    """Delivery days by customer state, next to the promised days."""
    orders = arrived_orders(t, "purchased_at")
    located = lookup_join(orders, customer_places(t), "customer_id")
    rolled = distinct_rollup(
        located,
        ["STATE"],
        "order_id",
        measures={
            "took": days_to_deliver(),
            "promised": days_between(F.col("purchased_at"), F.col("estimated_at")),
        },
    )
    return rolled.select(
        "STATE",
        F.col("n").alias("TOTAL_ORDERS"),
        half_up(mean_of("took"), 1).alias("AVG_DELIVERY_DAYS"),
        half_up(F.col("took_min"), 1).alias("MIN_DELIVERY_DAYS"),
        half_up(F.col("took_max"), 1).alias("MAX_DELIVERY_DAYS"),
        half_up(mean_of("promised"), 1).alias("AVG_ESTIMATED_DAYS"),
    )


def delivery_time_report(t: Tables) -> DataFrame:
    order = [descending("AVG_DELIVERY_DAYS"), ascending("STATE")]
    return ranked(delivery_time_by_state(t), order)


def late_deliveries(t: Tables, month_names: bool = True) -> DataFrame:
    """Late and punctual orders by purchase month; mean days over all of them."""
    arrived = arrived_orders(t, "estimated_at").select(
        "*", month_start(F.col("purchased_at")).alias("m")
    )
    rolled = distinct_rollup(
        arrived,
        ["m"],
        "order_id",
        flags={"late": is_late(), "punctual": ~is_late()},
        measures={"late": days_late()},
        unique=t.unique_orders,
    )
    report = rolled.select(
        F.year("m").alias("YEAR"),
        F.month("m").alias("MONTH"),
        F.monthname("m").alias("MONTH_NAME"),
        F.col("n").alias("TOTAL_ORDERS"),
        F.col("n_late").alias("LATE_ORDERS"),
        F.col("n_punctual").alias("ON_TIME_ORDERS"),
        percent(F.col("n_late"), F.col("n")).alias("LATE_RATE_PCT"),
        half_up(mean_of("late"), 1).alias("AVG_DAYS_LATE"),
    )
    return report if month_names else report.drop("MONTH_NAME")


def late_deliveries_report(t: Tables) -> DataFrame:
    report = late_deliveries(t, month_names=False)
    return ranked(report, [ascending("YEAR"), ascending("MONTH")])


def delay_rate_by_state(t: Tables) -> DataFrame:
    """Late share by state; mean days of the late orders only."""
    orders = arrived_orders(t, "estimated_at")
    located = lookup_join(orders, customer_places(t), "customer_id")
    rolled = distinct_rollup(
        located,
        ["STATE"],
        "order_id",
        flags={"late": is_late()},
        measures={"late": F.when(is_late(), days_late())},
    )
    report = rolled.select(
        "STATE",
        F.col("n").alias("TOTAL_ORDERS"),
        F.col("n_late").alias("LATE_ORDERS"),
        percent(F.col("n_late"), F.col("n")).alias("LATE_RATE_PCT"),
        half_up(mean_of("late"), 1).alias("AVG_DAYS_LATE"),
    )
    return ranked(report, [descending("LATE_RATE_PCT"), ascending("STATE")])


def delay_by_category(t: Tables) -> DataFrame:
    """Late share and mean delivery days (per item row) of larger categories."""
    both = F.col("delivered_at").isNotNull() & F.col("estimated_at").isNotNull()
    rolled = distinct_rollup(
        sales_lines(t).where(both),
        ["CATEGORY"],
        "order_id",
        flags={"late": is_late()},
        measures={"took": days_to_deliver()},
    )
    return rolled.where(F.col("n") >= MIN_CATEGORY_ORDERS).select(
        "CATEGORY",
        F.col("n").alias("TOTAL_ORDERS"),
        F.col("n_late").alias("LATE_ORDERS"),
        percent(F.col("n_late"), F.col("n")).alias("LATE_RATE_PCT"),
        half_up(mean_of("took"), 1).alias("AVG_DELIVERY_DAYS"),
    )


def delay_by_category_report(t: Tables, limit: int = 15) -> DataFrame:
    order = [descending("LATE_RATE_PCT"), ascending("CATEGORY")]
    return ranked(delay_by_category(t), order, limit)


def delay_label() -> Column:
    """Fixed buckets of days past the promise; the first match wins."""
    late = days_late()
    return (
        F.when(late <= -7, "very early (7+ days before)")
        .when(late <= -1, "early (1-6 days before)")
        .when(late == 0, "on time")
        .when(late <= 7, "late (1-7 days)")
        .otherwise("very late (7+ days)")
    )


def delay_vs_review(t: Tables) -> DataFrame:
    """Review scores by delay bucket."""
    arrived = arrived_orders(t, "estimated_at").select(
        "order_id", delay_label().alias("DELIVERY_STATUS")
    )
    rolled = distinct_rollup(
        t.order_reviews.select("order_id", "review_score").join(arrived, "order_id"),
        ["DELIVERY_STATUS"],
        "order_id",
        measures={"score": F.col("review_score")},
    )
    report = rolled.select(
        "DELIVERY_STATUS",
        F.col("n").alias("TOTAL_ORDERS"),
        half_up(mean_of("score"), 2).alias("AVG_REVIEW_SCORE"),
        half_up(F.col("score_min"), 2).alias("MIN_SCORE"),
        half_up(F.col("score_max"), 2).alias("MAX_SCORE"),
    )
    return ranked(report, [descending("AVG_REVIEW_SCORE"), ascending("DELIVERY_STATUS")])
