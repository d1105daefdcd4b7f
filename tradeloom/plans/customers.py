"""Customer models: spend, lifetime value, loyalty, profile by place.

All of them aggregate to one row per customer before they touch the customer
table, so a customer with very many orders is reduced by partial aggregation and
the customer join moves one row per customer. An order belongs to one customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.columns import (
    ascending,
    descending,
    half_up,
    percent,
    ratio,
)
from tradeloom.functions.money import exact_sum
from tradeloom.operators.lookups import lookup_join
from tradeloom.operators.rollups import (
    distinct_rollup,
    group_total,
    mean_of,
    ranked,
)
from tradeloom.plans.lines import delivered_orders, paid_lines
from tradeloom.sources.tables import Tables

# Smallest group of customers the single-purchase report shows.
MIN_PLACE_CUSTOMERS = 50


def customer_places(t: Tables) -> DataFrame:
    return t.customers.select(
        "customer_id",
        F.col("customer_state").alias("STATE"),
        F.col("customer_city").alias("CITY"),
    )


def customer_value(t: Tables) -> DataFrame:
    """Per customer: distinct paid orders (`n`) and payment statistics (`paid_*`)."""
    return distinct_rollup(
        paid_lines(t),
        ["customer_id"],
        "order_id",
        measures={"paid": F.col("payment_value")},
    )


def order_counts(t: Tables) -> DataFrame:
    """Per customer: distinct delivered orders (`orders`)."""
    counted = distinct_rollup(delivered_orders(t), ["customer_id"], "order_id")
    return counted.withColumnRenamed("n", "orders")


def customers_by_spend(t: Tables) -> DataFrame:
    """Spend per customer; an order counts once per payment row."""
    orders = delivered_orders(t).select("order_id", "customer_id", "purchased_at")
    payments = t.order_payments.select("order_id", "payment_value")
    spent = (
        orders.join(payments, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("lines"),
            exact_sum(F.col("payment_value")).alias("paid_sum"),
            F.count("payment_value").alias("paid_cnt"),
            F.min("purchased_at").alias("first_at"),
            F.max("purchased_at").alias("last_at"),
        )
    )
    # Grouped once more because a customer row may be missing or repeated; the
    # grouping uses the partitioning of the join.
    merged = (
        lookup_join(spent, customer_places(t), "customer_id", "left")
        .groupBy("customer_id", "CITY", "STATE")
        .agg(
            F.sum("lines").alias("lines"),
            exact_sum(F.col("paid_sum")).alias("paid_sum"),
            F.sum("paid_cnt").alias("paid_cnt"),
            F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"),
        )
    )
    return merged.select(
        F.col("customer_id").alias("CUSTOMER_ID"),
        F.col("CITY").alias("CIDADE"),
        F.col("STATE").alias("ESTADO"),
        F.col("lines").alias("TOTAL_PEDIDOS"),
        half_up(F.col("paid_sum"), 2).alias("VALOR_TOTAL_GASTO"),
        half_up(mean_of("paid"), 2).alias("TICKET_MEDIO"),
        F.col("first_at").alias("PRIMEIRA_COMPRA"),
        F.col("last_at").alias("ULTIMA_COMPRA"),
    )


def profile_by_city(t: Tables) -> DataFrame:
    """Customers, payment rows, revenue and favourite payment type per city.

    The favourite is the most frequent type, the smallest name on a tie.
    """
    orders = delivered_orders(t).select("order_id", "customer_id")
    payments = t.order_payments.select("order_id", "payment_type", "payment_value")
    known = F.col("CITY").isNotNull() & F.col("STATE").isNotNull()
    per_customer = (
        orders.join(payments, "order_id", "left")
        .groupBy("customer_id", "payment_type")
        .agg(
            F.count("order_id").alias("lines"),
            exact_sum(F.col("payment_value")).alias("paid_sum"),
            F.count("payment_value").alias("paid_cnt"),
        )
    )
    located = lookup_join(per_customer, customer_places(t).where(known), "customer_id")
    # A customer is counted on the first of its payment types.
    types = Window.partitionBy("customer_id", "STATE", "CITY").orderBy("payment_type")
    per_type = (
        located.withColumn("opens", (F.row_number().over(types) == 1).cast("int"))
        .groupBy("STATE", "CITY", "payment_type")
        .agg(
            F.sum("opens").alias("customers"),
            F.sum("lines").alias("lines"),
            exact_sum(F.col("paid_sum")).alias("paid_sum"),
            F.sum("paid_cnt").alias("paid_cnt"),
        )
    )
    votes = F.when(
        F.col("payment_type").isNotNull(), F.struct(-F.col("lines"), "payment_type")
    )
    per_city = per_type.groupBy("STATE", "CITY").agg(
        F.sum("customers").alias("TOTAL_CLIENTES"),
        F.sum("lines").alias("TOTAL_PEDIDOS"),
        exact_sum(F.col("paid_sum")).alias("paid_sum"),
        F.sum("paid_cnt").alias("paid_cnt"),
        F.min_by("payment_type", votes).alias("PAGAMENTO_PREFERIDO"),
    )
    return per_city.select(
        F.col("STATE").alias("ESTADO"),
        F.col("CITY").alias("CIDADE"),
        "TOTAL_CLIENTES",
        "TOTAL_PEDIDOS",
        half_up(mean_of("paid"), 2).alias("TICKET_MEDIO"),
        half_up(F.col("paid_sum"), 2).alias("RECEITA_TOTAL"),
        "PAGAMENTO_PREFERIDO",
    )


def profile_by_state(t: Tables) -> DataFrame:
    """Lifetime value by state, where a value counts once per delivered order.

    The repetition is part of the definition. Instead of joining the orders a
    second time, each customer carries its number of order rows as a weight, so
    orders are read and shuffled once.
    """
    per_order = t.order_payments.groupBy("order_id").agg(
        exact_sum(F.col("payment_value")).alias("value"), F.count(F.lit(1)).alias("slips")
    )
    placed = (
        delivered_orders(t)
        .select("order_id", "customer_id")
        .join(per_order, "order_id", "left")
    )
    per_customer = distinct_rollup(
        placed,
        ["customer_id"],
        "order_id",
        flags={"paid": F.col("slips").isNotNull()},
        measures={"value": F.col("value"), "rows": F.lit(1)},
    ).where(F.col("n_paid") > 0)
    weight, value = F.col("rows_sum"), F.col("value_sum")
    located = lookup_join(per_customer, customer_places(t), "customer_id").select(
        "STATE",
        "customer_id",
        "n",
        value.alias("value"),
        (value * weight).alias("value_total"),
        F.when(value.isNotNull(), weight).alias("value_weight"),
        (F.col("n_paid") * weight).alias("order_total"),
        weight.alias("order_weight"),
    )
    names = ["value", "value_total", "value_weight", "order_total", "order_weight"]
    rolled = distinct_rollup(
        located,
        ["STATE"],
        "customer_id",
        measures={c: F.col(c) for c in names},
        once={"orders": F.col("n")},
    )

    def weighted_mean(total: str, count: str):
        return ratio(F.col(f"{total}_sum"), F.col(f"{count}_sum"))

    return rolled.select(
        "STATE",
        F.col("n").alias("TOTAL_CUSTOMERS"),
        F.col("orders_once").alias("TOTAL_ORDERS"),
        half_up(weighted_mean("value_total", "value_weight"), 2).alias(
            "AVG_LIFETIME_VALUE"
        ),
        half_up(F.col("value_max"), 2).alias("MAX_LIFETIME_VALUE"),
        half_up(F.col("value_min"), 2).alias("MIN_LIFETIME_VALUE"),
        half_up(F.col("value_total_sum"), 2).alias("TOTAL_REVENUE"),
        half_up(weighted_mean("order_total", "order_weight"), 1).alias(
            "AVG_ORDERS_PER_CUSTOMER"
        ),
        percent(F.col("value_total_sum"), group_total("value_total_sum")).alias(
            "REVENUE_SHARE_PCT"
        ),
    )


def single_purchase_customers(t: Tables, limit: int | None = 20) -> DataFrame:
    """Share of customers with exactly one delivered order, by city."""
    rolled = distinct_rollup(
        lookup_join(order_counts(t), customer_places(t), "customer_id"),
        ["STATE", "CITY"],
        "customer_id",
        flags={"single": F.col("orders") == 1},
    )
    report = rolled.where(F.col("n") >= MIN_PLACE_CUSTOMERS).select(
        "STATE",
        "CITY",
        F.col("n_single").alias("SINGLE_PURCHASE_CUSTOMERS"),
        F.col("n").alias("TOTAL_CUSTOMERS"),
        percent(F.col("n_single"), F.col("n")).alias("CHURN_RATE_PCT"),
    )
    order = [descending("CHURN_RATE_PCT"), ascending("STATE"), ascending("CITY")]
    return ranked(report, order, limit)


def customers_above_mean(t: Tables) -> DataFrame:
    """Customers above and at or below the mean of the customers' mean payment.

    Means are rounded per customer and again over all customers. The overall mean
    is a scalar subquery, so no join is involved.
    """
    means = customer_value(t).select(
        "customer_id", half_up(mean_of("paid"), 2).alias("ticket")
    )
    overall = means.select(half_up(F.avg("ticket"), 2)).scalar()
    judged = means.select("*", overall.alias("GLOBAL_AVG_TICKET"))
    known = F.col("customer_id").isNotNull()
    gap = F.col("ticket") - F.col("GLOBAL_AVG_TICKET")
    return (
        judged.groupBy("GLOBAL_AVG_TICKET")
        .agg(
            F.count("customer_id").alias("TOTAL_CUSTOMERS"),
            F.count_if(known & (gap > 0)).alias("CUSTOMERS_ABOVE_AVG"),
            F.count_if(known & (gap <= 0)).alias("CUSTOMERS_BELOW_AVG"),
        )
        .withColumn(
            "PCT_ABOVE_AVG",
            percent(F.col("CUSTOMERS_ABOVE_AVG"), F.col("TOTAL_CUSTOMERS")),
        )
    )


def _value_by_state(t: Tables, value) -> DataFrame:
    """Distinct customers by state with their order counts and lifetime value."""
    values = customer_value(t).select(
        "customer_id", F.col("n").alias("orders"), value.alias("value")
    )
    located = lookup_join(values, customer_places(t), "customer_id")
    return distinct_rollup(
        located,
        ["STATE"],
        "customer_id",
        measures={"value": F.col("value"), "orders": F.col("orders")},
    )


def geographic_profile(t: Tables) -> DataFrame:
    """Lifetime value by state; values are rounded per customer first."""
    rolled = _value_by_state(t, half_up(F.col("paid_sum"), 2))
    report = rolled.select(
        "STATE",
        F.col("n").alias("TOTAL_CUSTOMERS"),
        half_up(mean_of("value"), 2).alias("AVG_LIFETIME_VALUE"),
        half_up(F.col("value_sum"), 2).alias("TOTAL_REVENUE"),
        half_up(mean_of("orders"), 1).alias("AVG_ORDERS_PER_CUSTOMER"),
        percent(F.col("value_sum"), group_total("value_sum")).alias("REVENUE_SHARE_PCT"),
    )
    return ranked(report, [descending("TOTAL_REVENUE"), ascending("STATE")])


def lifetime_value_by_state(t: Tables) -> DataFrame:
    """Mean, largest and smallest lifetime value by state."""
    report = _value_by_state(t, F.col("paid_sum")).select(
        "STATE",
        F.col("n").alias("TOTAL_CUSTOMERS"),
        half_up(mean_of("value"), 2).alias("AVG_LTV"),
        half_up(F.col("value_max"), 2).alias("MAX_LTV"),
        half_up(F.col("value_min"), 2).alias("MIN_LTV"),
        half_up(mean_of("orders"), 1).alias("AVG_ORDERS"),
    )
    return ranked(report, [descending("AVG_LTV"), ascending("STATE")])


def recurring_customers(t: Tables) -> DataFrame:
    """One-time and recurring buyers by state."""
    rolled = distinct_rollup(
        lookup_join(order_counts(t), customer_places(t), "customer_id"),
        ["STATE"],
        "customer_id",
        flags={"once": F.col("orders") == 1, "again": F.col("orders") > 1},
    )
    report = rolled.select(
        "STATE",
        F.col("n").alias("TOTAL_CUSTOMERS"),
        F.col("n_once").alias("ONE_TIME_BUYERS"),
        F.col("n_again").alias("RECURRING_BUYERS"),
        percent(F.col("n_again"), F.col("n")).alias("RECURRING_RATE_PCT"),
    )
    return ranked(report, [descending("RECURRING_RATE_PCT"), ascending("STATE")])
