"""Running revenue shares over products and customers, of which there is no bound.

Revenue is rounded per product or customer and added as decimals, so that the running sums
do not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import ascending, descending, half_up, percent
from tradeloom.functions.money import exact_sum
from tradeloom.operators.ranges import running_totals, with_previous
from tradeloom.plans.lines import paid_lines, sales_lines
from tradeloom.sources.tables import Tables


def _best_first(key: str) -> list[Column]:
    return [descending("TOTAL_REVENUE"), ascending(key)]


def _with_shares(revenue: DataFrame, key: str) -> DataFrame:
    exact = F.col("TOTAL_REVENUE").cast("decimal(28,2)")
    told = running_totals(revenue, _best_first(key), {"revenue": exact})
    share = percent(F.col("TOTAL_REVENUE"), F.col("revenue_whole"))
    so_far = percent(F.col("revenue_so_far"), F.col("revenue_whole"))
    return told.select(*revenue.columns, share.alias("REVENUE_SHARE_PCT"), so_far.alias("CUMULATIVE_SHARE_PCT"))


def pareto_by_product(t: Tables) -> DataFrame:
    """Revenue, share and running share of every product sold, from the best on."""
    revenue = sales_lines(t).groupBy(F.col("product_id").alias("PRODUCT_ID"))
    return _with_shares(revenue.agg(half_up(exact_sum(F.col("price")), 2).alias("TOTAL_REVENUE")), "PRODUCT_ID")


def pareto_by_customer(t: Tables) -> DataFrame:
    """What every customer paid, with shares, and how far the next better one is ahead."""
    paid = paid_lines(t).groupBy(F.col("customer_id").alias("CUSTOMER_ID"))
    revenue = paid.agg(half_up(exact_sum(F.col("payment_value")), 2).alias("TOTAL_REVENUE"))
    ahead = with_previous(revenue, _best_first("CUSTOMER_ID"), "TOTAL_REVENUE", "better")
    gap = half_up(F.col("better") - F.col("TOTAL_REVENUE"), 2)
    return _with_shares(ahead.select("CUSTOMER_ID", "TOTAL_REVENUE", gap.alias("GAP_TO_BETTER")), "CUSTOMER_ID")
