"""Calendar models: months, weekday hours, commercial dates, best category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.columns import (
    CANCELED,
    DELIVERED,
    ascending,
    day_start,
    days_between,
    descending,
    half_up,
    month_start,
    percent,
    weekday_number,
)
from tradeloom.operators.rollups import distinct_rollup, group_total, ranked
from tradeloom.plans.lines import delivered_orders, paid_lines, sales_lines
from tradeloom.plans.sales import monthly_revenue
from tradeloom.sources.tables import Tables

# Label -> month and day, the same in every year.
COMMERCIAL_DATES = {
    "Black Friday 2017": ["11-24"],
    "Black Friday 2018": ["11-23"],
    "Christmas": ["12-24", "12-25"],
    "New Year": ["01-01", "01-02"],
    "Valentines": ["02-12", "02-13", "02-14"],
    "Mothers Day": ["05-13", "05-14"],
}
ORDINARY_DATE = "regular day"


def monthly_orders(t: Tables) -> DataFrame:
    """Orders of any status per month, with delivered and cancelled counts."""
    month, status = F.col("order_month"), F.col("status")
    counted = (
        t.placed_orders.where(month.isNotNull())
        .groupBy("order_month")
        .agg(
            F.count("order_id").alias("TOTAL_PEDIDOS"),
            F.count_if(status == DELIVERED).alias("PEDIDOS_ENTREGUES"),
            F.count_if(status == CANCELED).alias("PEDIDOS_CANCELADOS"),
        )
    )
    return counted.select(
        month.alias("MES"),
        F.year(month).alias("ANO"),
        F.month(month).alias("NUMERO_MES"),
        "TOTAL_PEDIDOS",
        "PEDIDOS_ENTREGUES",
        "PEDIDOS_CANCELADOS",
        percent(F.col("PEDIDOS_CANCELADOS"), F.col("TOTAL_PEDIDOS")).alias(
            "TAXA_CANCELAMENTO_PCT"
        ),
    )


def order_hours(t: Tables) -> DataFrame:
    """Orders of any status by hour and weekday; delivery days of delivered ones."""
    took = F.when(
        F.col("status") == DELIVERED,
        days_between(F.col("purchased_at"), F.col("delivered_at")),
    )
    return (
        t.placed_orders.where(F.col("purchased_at").isNotNull())
        .groupBy(
            F.col("hour_of_day").alias("HORA_DO_DIA"),
            F.col("weekday").alias("DIA_DA_SEMANA"),
        )
        .agg(
            F.count("order_id").alias("TOTAL_PEDIDOS"),
            half_up(F.avg(took), 1).alias("MEDIA_DIAS_ENTREGA"),
        )
    )


def seasonality(t: Tables, month_dates: bool = True) -> DataFrame:
    """Monthly revenue and its share of the year."""
    report = monthly_revenue(t).withColumn(
        "MONTHLY_SHARE_PCT",
        percent(F.col("value_sum"), group_total("value_sum", "YEAR")),
    )
    report = report.drop("value_sum")
    return report if month_dates else report.drop("MONTH_DATE")


def seasonality_report(t: Tables) -> DataFrame:
    report = seasonality(t, month_dates=False)
    return ranked(report, [ascending("YEAR"), ascending("MONTH")])


def peak_hours(t: Tables) -> DataFrame:
    """Delivered orders by weekday and hour, with the share of the weekday."""
    moment = F.col("purchased_at")
    slots = delivered_orders(t).select(
        "order_id",
        weekday_number(moment).alias("DAY_NUMBER"),
        F.dayname(moment).alias("DAY_NAME"),
        F.hour(moment).alias("HOUR_OF_DAY"),
    )
    keys = ["DAY_NUMBER", "DAY_NAME", "HOUR_OF_DAY"]
    rolled = distinct_rollup(slots, keys, "order_id", unique=t.unique_orders)
    return rolled.select(
        "DAY_NUMBER",
        "DAY_NAME",
        "HOUR_OF_DAY",
        F.col("n").alias("TOTAL_ORDERS"),
        percent(F.col("n"), group_total("n", "DAY_NUMBER")).alias("HOUR_SHARE_PCT"),
    )


def peak_hours_report(t: Tables) -> DataFrame:
    order = [descending("TOTAL_ORDERS"), ascending("DAY_NUMBER"), ascending("HOUR_OF_DAY")]
    return ranked(peak_hours(t), order)


def top_category_by_month(t: Tables) -> DataFrame:
    """The category with the highest revenue in each month."""
    items = sales_lines(t).select(
        "order_id", "CATEGORY", "price", month_start(F.col("purchased_at")).alias("m")
    )
    rolled = distinct_rollup(
        items, ["m", "CATEGORY"], "order_id", measures={"price": F.col("price")}
    )
    monthly = rolled.select(
        F.year("m").alias("YEAR"),
        F.month("m").alias("MONTH"),
        F.monthname("m").alias("MONTH_NAME"),
        F.col("CATEGORY").alias("TOP_CATEGORY"),
        F.col("n").alias("TOTAL_ORDERS"),
        half_up(F.col("price_sum"), 2).alias("TOTAL_REVENUE"),
    )
    best_first = Window.partitionBy("YEAR", "MONTH").orderBy(
        descending("TOTAL_REVENUE"), ascending("TOP_CATEGORY")
    )
    placed = monthly.withColumn("place", F.row_number().over(best_first))
    return placed.where(F.col("place") == 1).drop("place")


def top_category_report(t: Tables) -> DataFrame:
    return ranked(top_category_by_month(t), [ascending("YEAR"), ascending("MONTH")])


def date_label(day: Column) -> Column:
    """Commercial date a day falls on, by month and day only."""
    month_day = F.date_format(day, "MM-dd")
    label = None
    for name, days in COMMERCIAL_DATES.items():
        hit = month_day.isin(days)
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return label.otherwise(ORDINARY_DATE)


def seasonal_dates(t: Tables) -> DataFrame:
    """Orders and revenue per day, labelled with its commercial date."""
    paid = paid_lines(t).select(
        "order_id", day_start(F.col("purchased_at")).alias("ORDER_DATE"), "payment_value"
    )
    rolled = distinct_rollup(
        paid, ["ORDER_DATE"], "order_id", measures={"value": F.col("payment_value")}
    )
    return rolled.select(
        "ORDER_DATE",
        F.col("n").alias("TOTAL_ORDERS"),
        half_up(F.col("value_sum"), 2).alias("TOTAL_REVENUE"),
        date_label(F.col("ORDER_DATE")).alias("DATE_TYPE"),
    )


def busiest_days(t: Tables, limit: int = 30) -> DataFrame:
    order = [descending("TOTAL_ORDERS"), ascending("ORDER_DATE")]
    return ranked(seasonal_dates(t), order, limit)
