"""Review models: scores by category, distribution, delivery and answer time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import (
    ascending,
    days_between,
    descending,
    half_up,
    percent,
    ratio,
)
from tradeloom.operators.rollups import distinct_rollup, group_total, mean_of, ranked
from tradeloom.plans.delivery import days_to_deliver
from tradeloom.plans.lines import (
    arrived_orders,
    delivered_orders,
    lines_per_order,
    sales_lines,
    weighted,
)
from tradeloom.plans.sales import MIN_CATEGORY_ORDERS
from tradeloom.sources.tables import Tables


def scores_per_order(t: Tables) -> DataFrame:
    """Per order: score statistics and whether any review is good, bad, 1 or 5."""
    score = F.col("review_score")
    return t.order_reviews.groupBy("order_id").agg(
        F.sum(score).alias("score_sum"),
        F.count(score).alias("score_cnt"),
        F.max(score == 5).alias("five"),
        F.max(score == 1).alias("one"),
        F.max(score >= 4).alias("positive"),
        F.max(score <= 2).alias("negative"),
    )


def reviewed_orders(t: Tables, lines: DataFrame, *keys: str) -> DataFrame:
    """Reviewed orders per item key, scores weighted by item rows.

    Both sides hold one row per order (and item key), so an order with many items
    and many reviews does not multiply out.
    """
    per_order = lines_per_order(lines, *keys).join(scores_per_order(t), "order_id")
    return per_order.select("*", *weighted("score"))


def score_mean() -> Column:
    """Weighted mean score after a rollup of `reviewed_orders`."""
    return ratio(F.col("score_total_sum"), F.col("score_count_sum"))


def reviews_by_category(t: Tables) -> DataFrame:
    """Scores and good/bad shares of the categories with enough orders."""
    rolled = distinct_rollup(
        reviewed_orders(t, sales_lines(t), "CATEGORY"),
        ["CATEGORY"],
        "order_id",
        flags={name: F.col(name) for name in ("five", "one", "positive", "negative")},
        measures={name: F.col(name) for name in ("score_total", "score_count")},
    )
    return rolled.where(F.col("n") >= MIN_CATEGORY_ORDERS).select(
        "CATEGORY",
        F.col("n").alias("TOTAL_ORDERS"),
        half_up(score_mean(), 2).alias("AVG_SCORE"),
        F.col("n_five").alias("FIVE_STAR"),
        F.col("n_one").alias("ONE_STAR"),
        percent(F.col("n_negative"), F.col("n")).alias("NEGATIVE_RATE_PCT"),
        percent(F.col("n_positive"), F.col("n")).alias("POSITIVE_RATE_PCT"),
    )


def worst_reviewed_categories(t: Tables, limit: int = 15) -> DataFrame:
    report = reviews_by_category(t).select(
        "CATEGORY",
        "TOTAL_ORDERS",
        "AVG_SCORE",
        "ONE_STAR",
        "FIVE_STAR",
        "NEGATIVE_RATE_PCT",
    )
    return ranked(report, [ascending("AVG_SCORE"), ascending("CATEGORY")], limit)


def score_distribution(t: Tables) -> DataFrame:
    """Reviews of delivered orders per score, with mean delivery days."""
    orders = delivered_orders(t).select("order_id", days_to_deliver().alias("took"))
    reviews = t.order_reviews.select(
        "order_id", "review_id", F.col("review_score").alias("SCORE")
    )
    rolled = distinct_rollup(
        reviews.join(orders, "order_id"),
        ["SCORE"],
        "review_id",
        measures={"took": F.col("took")},
    )
    report = rolled.select(
        "SCORE",
        F.col("n").alias("TOTAL_REVIEWS"),
        percent(F.col("n"), group_total("n")).alias("SHARE_PCT"),
        half_up(mean_of("took"), 1).alias("AVG_DELIVERY_DAYS"),
    )
    return ranked(report, [descending("SCORE")])


def duration_label() -> Column:
    """Fixed buckets of delivery days; the first match wins."""
    took = days_to_deliver()
    return (
        F.when(took <= 3, "1-3 days")
        .when(took <= 7, "4-7 days")
        .when(took <= 14, "8-14 days")
        .when(took <= 21, "15-21 days")
        .otherwise("22+ days")
    )


def delivery_time_vs_review(t: Tables) -> DataFrame:
    """Scores by delivery time bucket."""
    arrived = arrived_orders(t, "purchased_at").select(
        "order_id", duration_label().alias("DELIVERY_RANGE")
    )
    rolled = distinct_rollup(
        t.order_reviews.select("order_id", "review_score").join(arrived, "order_id"),
        ["DELIVERY_RANGE"],
        "order_id",
        flags={"positive": F.col("review_score") >= 4},
        measures={"score": F.col("review_score")},
    )
    report = rolled.select(
        "DELIVERY_RANGE",
        F.col("n").alias("TOTAL_ORDERS"),
        half_up(mean_of("score"), 2).alias("AVG_SCORE"),
        percent(F.col("n_positive"), F.col("n")).alias("POSITIVE_RATE_PCT"),
    )
    return ranked(report, [descending("AVG_SCORE"), ascending("DELIVERY_RANGE")])


def response_label(created: Column, answered: Column) -> Column:
    """Fixed buckets of days until the answer; the first match wins."""
    waited = days_between(created, answered)
    return (
        F.when(waited == 0, "same day")
        .when(waited <= 3, "1-3 days")
        .when(waited <= 7, "4-7 days")
        .otherwise("7+ days")
    )


def response_time_vs_review(t: Tables) -> DataFrame:
    """Scores of answered reviews by answer time."""
    created, answered = F.col("review_creation_date"), F.col("review_answer_timestamp")
    reviews = t.order_reviews.where(created.isNotNull() & answered.isNotNull()).select(
        "order_id",
        "review_id",
        "review_score",
        response_label(
            created.cast("timestamp_ntz"), answered.cast("timestamp_ntz")
        ).alias("RESPONSE_TIME"),
    )
    rolled = distinct_rollup(
        reviews.join(delivered_orders(t).select("order_id"), "order_id"),
        ["RESPONSE_TIME"],
        "review_id",
        flags={"positive": F.col("review_score") >= 4},
        measures={"score": F.col("review_score")},
    )
    report = rolled.select(
        "RESPONSE_TIME",
        F.col("n").alias("TOTAL_REVIEWS"),
        half_up(mean_of("score"), 2).alias("AVG_SCORE"),
        percent(F.col("n_positive"), F.col("n")).alias("POSITIVE_RATE_PCT"),
    )
    return ranked(report, [descending("AVG_SCORE"), ascending("RESPONSE_TIME")])
