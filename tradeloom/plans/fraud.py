"""Rule-based fraud signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.sources.tables import Tables

# Rule names, and risk levels with their smallest customer count.
SHARED_CARD = "shared_credit_card"
NEGATIVE_PAYMENT = "negative_payment_value"
EARLY_DELIVERY = "delivery_before_purchase"
CARD_RISK = {"critical": 10, "high": 5, "medium": 2}
LOWEST_RISK = "low"
NAME_SEPARATOR = " | "


def _card_holders(t: Tables) -> DataFrame:
    return t.customers_extended.where(F.col("credit_card_token").isNotNull())


def card_members(t: Tables) -> DataFrame:
    """Customers whose card token occurs on more than one row.

    A cheap first cut by row counts, so that the distinct counts that follow only
    see the few customers behind repeated tokens.

    The list of tokens gets an exchange of its own. Its real size is then known
    before the join: a short list is broadcast, and for a long one the partition of
    a token with very many customers can be split.
    """
    people = _card_holders(t)
    repeated = (
        people.groupBy("credit_card_token")
        .agg(F.count(F.lit(1)).alias("holders"))
        .where(F.col("holders") > 1)
        .select("credit_card_token")
        .hint("rebalance")
    )
    return people.join(repeated, "credit_card_token", "left_semi")


def card_figures(t: Tables) -> DataFrame:
    """One row per shared token with its distinct customers, names and places.

    Each value is deduplicated by (token, value) before the rows of a token meet, so
    a token with very many customers is spread over tasks.
    """
    return (
        card_members(t)
        .groupBy(F.col("credit_card_token").alias("CREDIT_CARD_TOKEN"))
        .agg(
            F.count_distinct("customer_id").alias("CUSTOMERS_SHARING_CARD"),
            F.count_distinct("full_name").alias("DIFFERENT_NAMES"),
            F.count_distinct("customer_state").alias("DIFFERENT_STATES"),
            F.count_distinct("customer_city").alias("DIFFERENT_CITIES"),
        )
        .where(F.col("CUSTOMERS_SHARING_CARD") > 1)
    )


def card_names(t: Tables) -> DataFrame:
    """NAMES_LIST of every shared token: its distinct names in order, in one cell.

    Names are deduplicated by (token, name) first; what meets in one task is the list
    itself, which the definition wants in one cell.
    """
    names = card_members(t).select(
        F.col("credit_card_token").alias("CREDIT_CARD_TOKEN"), F.col("full_name").alias("name")
    )
    listed = (
        names.where(F.col("name").isNotNull())
        .distinct()
        .groupBy("CREDIT_CARD_TOKEN")
        .agg(F.array_sort(F.collect_list("name")).alias("names"))
    )
    return listed.select("CREDIT_CARD_TOKEN", F.array_join("names", NAME_SEPARATOR).alias("NAMES_LIST"))


def shared_cards(t: Tables) -> DataFrame:
    """The figures of every shared token with its list of names."""
    return (
        card_figures(t)
        .join(card_names(t), "CREDIT_CARD_TOKEN", "left")
        .select(
            "CREDIT_CARD_TOKEN",
            "CUSTOMERS_SHARING_CARD",
            "DIFFERENT_NAMES",
            "DIFFERENT_STATES",
            "DIFFERENT_CITIES",
            "NAMES_LIST",
        )
    )


def negative_payments(t: Tables) -> DataFrame:
    """Payments below zero."""
    return t.order_payments.where(F.col("payment_value") < 0).select(
        F.col("order_id").alias("ORDER_ID"),
        F.col("payment_value").alias("PAYMENT_VALUE"),
        F.col("payment_type").alias("PAYMENT_TYPE"),
        F.lit(NEGATIVE_PAYMENT).alias("FRAUD_TYPE"),
        F.lit("high").alias("RISK_LEVEL"),
    )


def invalid_dates(t: Tables) -> DataFrame:
    """Orders delivered before they were placed."""
    bought, arrived = F.col("ORDER_PURCHASED_AT"), F.col("ORDER_DELIVERED_AT")
    return t.stg_orders.where(arrived < bought).select(
        "ORDER_ID",
        bought,
        arrived,
        F.lit(EARLY_DELIVERY).alias("FRAUD_TYPE"),
        F.lit("high").alias("RISK_LEVEL"),
    )


def card_risk(customers: Column) -> Column:
    """Risk level of a token shared by that many customers."""
    level = None
    for name, least in CARD_RISK.items():
        hit = customers >= least
        level = F.when(hit, name) if level is None else level.when(hit, name)
    return level.otherwise(LOWEST_RISK)


def flagged_customers(t: Tables) -> DataFrame:
    """Every customer behind a shared token, with the token's figures and risk.

    The list of names is not part of it: it belongs to the token, and repeating it on
    every row would grow with the square of the customers of a token.
    """
    holders = _card_holders(t).select(
        F.col("customer_id").alias("CUSTOMER_ID"),
        F.col("full_name").alias("FULL_NAME"),
        F.col("email").alias("EMAIL"),
        F.col("credit_card_token").alias("CREDIT_CARD_TOKEN"),
        F.col("credit_card_last4").alias("CREDIT_CARD_LAST4"),
        F.col("customer_state").alias("CUSTOMER_STATE"),
        F.col("customer_city").alias("CUSTOMER_CITY"),
        F.col("is_synthetic").alias("IS_SYNTHETIC"),
        F.col("data_source").alias("DATA_SOURCE"),
    )
    # An exchange of its own, for the reason given in `card_members`.
    figures = card_figures(t).drop("DIFFERENT_CITIES").hint("rebalance")
    return holders.join(figures, "CREDIT_CARD_TOKEN").select(
        *holders.columns,
        "CUSTOMERS_SHARING_CARD",
        "DIFFERENT_NAMES",
        "DIFFERENT_STATES",
        card_risk(F.col("CUSTOMERS_SHARING_CARD")).alias("RISK_LEVEL"),
        F.lit(SHARED_CARD).alias("FRAUD_TYPE"),
    )


def with_names(flagged: DataFrame, names: DataFrame) -> DataFrame:
    """Flagged customers with the list of names of their token, joined where it is read."""
    return flagged.join(names.hint("rebalance"), "CREDIT_CARD_TOKEN", "left")


def fraud_customers(t: Tables) -> DataFrame:
    """The flagged customers with the list of names behind their card."""
    return with_names(flagged_customers(t), card_names(t)).select(
        "CUSTOMER_ID",
        "FULL_NAME",
        "EMAIL",
        "CREDIT_CARD_TOKEN",
        "CREDIT_CARD_LAST4",
        "CUSTOMER_STATE",
        "CUSTOMER_CITY",
        "IS_SYNTHETIC",
        "DATA_SOURCE",
        "CUSTOMERS_SHARING_CARD",
        "DIFFERENT_NAMES",
        "DIFFERENT_STATES",
        "NAMES_LIST",
        "RISK_LEVEL",
        "FRAUD_TYPE",
    )


SIGNAL_COLUMNS = [
    "CUSTOMER_ID",
    "FULL_NAME",
    "EMAIL",
    "CREDIT_CARD_TOKEN",
    "CREDIT_CARD_LAST4",
    "CUSTOMER_STATE",
    "CUSTOMER_CITY",
    "FRAUD_TYPE",
    "RISK_LEVEL",
    "CUSTOMERS_SHARING_CARD",
    "DIFFERENT_NAMES",
    "NAMES_LIST",
    "IS_SYNTHETIC",
    "DATA_SOURCE",
    "DETECTED_AT",
]


def stamped(flagged: DataFrame, detected_at: str | None) -> DataFrame:
    """With the detection moment; a fixed one makes runs repeatable."""
    stamp = F.lit(detected_at).cast("timestamp") if detected_at else F.current_timestamp()
    return flagged.withColumn("DETECTED_AT", stamp)


def stored_signals(t: Tables, detected_at: str | None = None) -> DataFrame:
    """The mart as it is stored: all columns but NAMES_LIST, one row per customer."""
    columns = [name for name in SIGNAL_COLUMNS if name != "NAMES_LIST"]
    return stamped(flagged_customers(t), detected_at).select(*columns)


def fraud_signals(t: Tables, detected_at: str | None = None) -> DataFrame:
    """The flagged customers, stamped with the detection moment."""
    return stamped(fraud_customers(t), detected_at).select(*SIGNAL_COLUMNS)


def all_signals(t: Tables) -> DataFrame:
    """All three rules in one list of (subject, rule, level)."""
    def signals(rows: DataFrame, subject: str) -> DataFrame:
        return rows.select(F.col(subject).alias("SUBJECT_ID"), "FRAUD_TYPE", "RISK_LEVEL")

    return (
        signals(flagged_customers(t), "CUSTOMER_ID")
        .unionByName(signals(negative_payments(t), "ORDER_ID"))
        .unionByName(signals(invalid_dates(t), "ORDER_ID"))
    )
