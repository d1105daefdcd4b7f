"""Sales models: categories, monthly revenue, payment methods, instalments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.columns import (
    CANCELED,
    CREDIT_CARD,
    ascending,
    descending,
    half_up,
    month_start,
    percent,
    ratio,
)
from tradeloom.functions.money import exact_decimal, exact_sum
from tradeloom.operators.lookups import lookup_join
from tradeloom.operators.rollups import (
    distinct_rollup,
    dual_distinct_rollup,
    group_total,
    mean_of,
    ranked,
)
from tradeloom.plans.lines import (
    categorised_items,
    delivered_orders,
    lines_per_order,
    paid_lines,
    sales_lines,
    weighted,
)
from tradeloom.sources.tables import Tables

# Smallest group of orders a category report shows.
MIN_CATEGORY_ORDERS = 100


def top_categories(t: Tables, limit: int = 10) -> DataFrame:
    """Best categories by revenue; the share is of all categories' revenue."""
    return category_report(category_totals(t), limit)


def category_totals(t: Tables) -> DataFrame:
    """Orders, products and prices of every category; a refresh stores them slice by slice."""

    def build() -> DataFrame:
        rolled = dual_distinct_rollup(
            sales_lines(t),
            ["CATEGORY"],
            first="order_id",
            second="product_id",
            measures={"price": F.col("price")},
        )
        return rolled.select("CATEGORY", "n_order_id", "n_product_id", "price_sum", "price_cnt")

    return t.shared("category_totals", build)


def category_report(rolled: DataFrame, limit: int) -> DataFrame:
    """The best of all categories, given orders, products and prices of each."""
    report = rolled.select(
        "CATEGORY",
        F.col("n_order_id").alias("TOTAL_ORDERS"),
        F.col("n_product_id").alias("UNIQUE_PRODUCTS"),
        half_up(F.col("price_sum"), 2).alias("TOTAL_REVENUE"),
        half_up(mean_of("price"), 2).alias("AVG_PRICE"),
        percent(F.col("price_sum"), group_total("price_sum")).alias("REVENUE_SHARE_PCT"),
    )
    return ranked(report, [descending("TOTAL_REVENUE"), ascending("CATEGORY")], limit)


def monthly_revenue(t: Tables) -> DataFrame:
    """One row per month with orders, revenue sum and mean payment (unrounded)."""
    moment = F.col("purchased_at")
    paid = paid_lines(t).select(
        "order_id", month_start(moment).alias("MONTH_DATE"), "payment_value"
    )
    rolled = distinct_rollup(
        paid, ["MONTH_DATE"], "order_id", measures={"value": F.col("payment_value")}
    )
    month = F.col("MONTH_DATE")
    return rolled.select(
        F.year(month).alias("YEAR"),
        F.month(month).alias("MONTH"),
        F.monthname(month).alias("MONTH_NAME"),
        "MONTH_DATE",
        F.col("n").alias("TOTAL_ORDERS"),
        half_up(F.col("value_sum"), 2).alias("TOTAL_REVENUE"),
        half_up(mean_of("value"), 2).alias("AVG_ORDER_VALUE"),
        "value_sum",
    )


def revenue_trend(t: Tables, month_names: bool = True) -> DataFrame:
    """Monthly revenue and its change against the last month that has any."""
    by_month = Window.orderBy(ascending("MONTH_DATE"))  # one row per month
    change = F.col("value_sum") - F.lag("value_sum").over(by_month)
    report = monthly_revenue(t).withColumn(
        "REVENUE_DIFF_PREV_MONTH", half_up(change, 2)
    )
    report = report.drop("value_sum")
    return report if month_names else report.drop("MONTH_NAME")


def revenue_trend_report(t: Tables) -> DataFrame:
    return ranked(revenue_trend(t, month_names=False), [ascending("MONTH_DATE")])


def cancellation_rate_by_category(t: Tables, limit: int | None = 15) -> DataFrame:
    """Share of cancelled orders per category, over orders of any status."""
    orders = t.placed_orders.select("order_id", "status")
    rolled = distinct_rollup(
        categorised_items(t).join(orders, "order_id"),
        ["CATEGORY"],
        "order_id",
        flags={"canceled": F.col("status") == CANCELED},
    )
    report = rolled.where(F.col("n") >= MIN_CATEGORY_ORDERS).select(
        "CATEGORY",
        F.col("n").alias("TOTAL_ORDERS"),
        F.col("n_canceled").alias("CANCELED_ORDERS"),
        percent(F.col("n_canceled"), F.col("n")).alias("CANCELLATION_RATE_PCT"),
    )
    order = [descending("CANCELLATION_RATE_PCT"), ascending("CATEGORY")]
    return ranked(report, order, limit)


def ticket_by_category(t: Tables) -> DataFrame:
    """Item price statistics of the categories with enough orders."""
    rolled = distinct_rollup(
        sales_lines(t),
        ["CATEGORY"],
        "order_id",
        measures={"price": F.col("price")},
    )
    return rolled.where(F.col("n") >= MIN_CATEGORY_ORDERS).select(
        "CATEGORY",
        F.col("n").alias("TOTAL_ORDERS"),
        half_up(F.col("price_sum"), 2).alias("TOTAL_REVENUE"),
        half_up(mean_of("price"), 2).alias("AVG_ITEM_PRICE"),
        half_up(F.col("price_min"), 2).alias("MIN_PRICE"),
        half_up(F.col("price_max"), 2).alias("MAX_PRICE"),
    )


def ticket_report(t: Tables, limit: int = 15) -> DataFrame:
    order = [descending("AVG_ITEM_PRICE"), ascending("CATEGORY")]
    return ranked(ticket_by_category(t), order, limit)


def pareto_by_category(t: Tables) -> DataFrame:
    """Revenue share and running share, both of the already rounded revenue.

    The running window sees one row per category, a small dimension.
    """
    revenue = sales_lines(t).groupBy("CATEGORY").agg(
        half_up(exact_sum(F.col("price")), 2).alias("TOTAL_REVENUE")
    )
    order = [descending("TOTAL_REVENUE"), ascending("CATEGORY")]
    so_far = Window.orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    whole = group_total("TOTAL_REVENUE")
    report = revenue.select(
        "CATEGORY",
        "TOTAL_REVENUE",
        percent(F.col("TOTAL_REVENUE"), whole).alias("REVENUE_SHARE_PCT"),
        percent(F.sum("TOTAL_REVENUE").over(so_far), whole).alias(
            "CUMULATIVE_SHARE_PCT"
        ),
    )
    return ranked(report, order)


def payment_method_by_state(t: Tables) -> DataFrame:
    """Orders and revenue by state and payment type, with the share in the state."""
    orders = delivered_orders(t).select("order_id", "customer_id")
    states = t.customers.select("customer_id", F.col("customer_state").alias("STATE"))
    placed = lookup_join(orders, states, "customer_id")
    paid = t.order_payments.select(
        "order_id", F.col("payment_type").alias("PAYMENT_METHOD"), "payment_value"
    )
    rolled = distinct_rollup(
        paid.join(placed, "order_id"),
        ["STATE", "PAYMENT_METHOD"],
        "order_id",
        measures={"value": F.col("payment_value")},
    )
    report = rolled.select(
        "STATE",
        "PAYMENT_METHOD",
        F.col("n").alias("TOTAL_ORDERS"),
        half_up(F.col("value_sum"), 2).alias("TOTAL_REVENUE"),
        half_up(mean_of("value"), 2).alias("AVG_ORDER_VALUE"),
        percent(F.col("n"), group_total("n", "STATE")).alias("PAYMENT_SHARE_PCT"),
    )
    order = [ascending("STATE"), descending("TOTAL_ORDERS"), ascending("PAYMENT_METHOD")]
    return ranked(report, order)


def exact_revenue(t: Tables) -> DataFrame:
    """Payments and their exact total per payment type and over all (no type), in cents.

    The total is rounded half away from zero once, after the sum.
    """
    paid = t.order_payments.select(F.col("payment_type").alias("PAYMENT_METHOD"), "payment_value")
    rolled = paid.rollup("PAYMENT_METHOD").agg(
        F.grouping("PAYMENT_METHOD").cast("int").alias("IS_TOTAL"),
        F.count("payment_value").alias("PAYMENTS"),
        exact_decimal(F.col("payment_value")).alias("total"),
    )
    cents = F.round(F.col("total") * 100, 0).cast("bigint")
    return rolled.select("PAYMENT_METHOD", "IS_TOTAL", "PAYMENTS", cents.alias("TOTAL_CENTS"))


def installments_by_category(t: Tables, limit: int | None = 15) -> DataFrame:
    """Card instalments and payment value per category, weighted by item rows."""
    card = (
        t.order_payments.where(F.col("payment_type") == CREDIT_CARD)
        .groupBy("order_id")
        .agg(
            F.sum("payment_installments").alias("inst_sum"),
            F.count("payment_installments").alias("inst_cnt"),
            F.max("payment_installments").alias("inst_max"),
            exact_sum(F.col("payment_value")).alias("value_sum"),
            F.count("payment_value").alias("value_cnt"),
        )
    )
    paired = (
        lines_per_order(sales_lines(t), "CATEGORY")
        .join(card, "order_id")
        .select("order_id", "CATEGORY", "inst_max", *weighted("inst"), *weighted("value"))
    )
    names = ["inst_max", "inst_total", "inst_count", "value_total", "value_count"]
    rolled = distinct_rollup(
        paired, ["CATEGORY"], "order_id", measures={c: F.col(c) for c in names}
    )

    def mean(name: str):
        return ratio(F.col(f"{name}_total_sum"), F.col(f"{name}_count_sum"))

    report = rolled.where(F.col("n") >= MIN_CATEGORY_ORDERS).select(
        "CATEGORY",
        F.col("n").alias("TOTAL_ORDERS"),
        half_up(mean("inst"), 1).alias("AVG_INSTALLMENTS"),
        half_up(mean("value"), 2).alias("AVG_ORDER_VALUE"),
        F.col("inst_max_max").alias("MAX_INSTALLMENTS"),
    )
    return ranked(report, [descending("AVG_INSTALLMENTS"), ascending("CATEGORY")], limit)
