"""Synthetic customers and orders for testing the fraud rules.

Every row is a function of its own id. The ids come as a frame with one bigint
column `id` (`spark.range(n)` for a fresh set), so generation is a narrow
transformation that scales with the number of partitions, and a rerun gives the
same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.columns import DELIVERED, half_up
from tradeloom.functions.identity import card_token, cpf, draw, pick, pick_weighted
from tradeloom.schemas import raw_schema

# Domains, and values with their weights.
STATES = [
    "SP", "RJ", "MG", "RS", "PR", "SC", "BA", "GO", "PE", "CE", "PA", "MA", "MS", "MT",
    "RN", "AL", "PB", "SE", "PI", "TO", "RO", "AM", "AC", "AP", "RR", "DF", "ES",
]
STATUSES = {"delivered": 5, "shipped": 1, "canceled": 1, "invoiced": 1, "processing": 1}
PAYMENT_TYPES = {"credit_card": 3, "boleto": 1, "voucher": 1, "debit_card": 1}
SCORE_BELOW = {5: 1, 10: 2, 20: 3, 50: 4}  # draw of 100 below key -> score, else 5
NORMAL_SOURCE = "synthetic_2019"
FRAUD_SOURCE = "synthetic_fraud_2019"
SHARED_CARD_OWNER = "99999"

AS_OF = "2026-01-01 00:00:00"
FIRST_PURCHASE = "2019-01-01 00:00:00"
PURCHASE_SECONDS = 364 * 86400
YEAR_SECONDS = 365 * 86400


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _later(unit: str, amount: Column, moment: Column) -> Column:
    return F.timestamp_add(unit, amount.cast("int"), moment)


def _padded(number: Column, width: int) -> Column:
    """At least `width` digits; longer numbers are kept whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def _four_digits(key: Column, label: str) -> Column:
    return (draw(key, label, 9000) + 1000).cast("string")


def _money(key: Column, label: str, low_cents: int, high_cents: int) -> Column:
    cents = draw(key, label, high_cents - low_cents + 1) + low_cents
    return cents.cast("double") / F.lit(100.0)


def _past(key: Column, label: str, as_of: str, years: int) -> Column:
    return _later("SECOND", -draw(key, label, years * YEAR_SECONDS), _moment(as_of))


def _people(ids: DataFrame, kind: str, as_of: str, years: int) -> DataFrame:
    """Columns both kinds of customers share, derived from the id."""
    number, key = F.col("number"), F.col("key")
    digits = _padded(draw(key, "cpf", 10**9), 9)
    keyed = ids.select(
        "id",
        F.col("id").cast("string").alias("number"),
        F.concat(F.lit(f"{kind}:"), F.col("id").cast("string")).alias("key"),
    ).withColumn("nine_digits", digits)
    return keyed.select(
        F.concat(
            F.lit(f"{kind}_"),
            _padded(F.col("id"), 6),
            F.lit("_"),
            F.substring(F.md5(key), 1, 8),
        ).alias("customer_id"),
        F.concat(F.lit(f"{kind} person "), number).alias("full_name"),
        F.concat(F.lit(f"{kind}."), number, F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+55"), _padded(draw(key, "phone", 10**11), 11)).alias("phone"),
        cpf(F.col("nine_digits")).alias("document_number"),
        _past(key, "consent", as_of, years).alias("lgpd_accepted_at"),
        _past(key, "created", as_of, years).alias("created_at"),
        F.lit(True).alias("is_synthetic"),
        number,
        key,
    )


def _ordered(df: DataFrame) -> DataFrame:
    return df.select(*raw_schema("customers_extended").names)


def normal_customers(ids: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Customers with a card of their own; consent always, marketing for 70%."""
    key, consent = F.col("key"), F.col("lgpd_accepted_at")
    opted = draw(key, "marketing", 10) < 7
    people = _people(ids, "synthetic", as_of, years=3).select(
        "*",
        card_token(F.col("number"), _four_digits(key, "salt")).alias("credit_card_token"),
        _four_digits(key, "last4").alias("credit_card_last4"),
        F.lit(True).alias("lgpd_accepted"),
        opted.alias("marketing_opt_in"),
        F.when(opted, consent).alias("marketing_opt_in_at"),
        pick(STATES, key, "state").alias("customer_state"),
        F.concat(F.lit("city "), draw(key, "city", 500).cast("string")).alias(
            "customer_city"
        ),
        F.lit(NORMAL_SOURCE).alias("data_source"),
    )
    return _ordered(people)


def fraud_customers(ids: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """Customers who all share one card, state and city."""
    key, cluster = F.col("key"), F.lit("fraud:cluster")
    people = _people(ids, "fraud", as_of, years=2).select(
        "*",
        card_token(F.lit(SHARED_CARD_OWNER), _four_digits(cluster, "salt")).alias(
            "credit_card_token"
        ),
        _four_digits(cluster, "last4").alias("credit_card_last4"),
        (draw(key, "accepted", 10) < 8).alias("lgpd_accepted"),
        (draw(key, "marketing", 10) < 5).alias("marketing_opt_in"),
        F.col("lgpd_accepted_at").alias("marketing_opt_in_at"),
        pick(STATES, cluster, "state").alias("customer_state"),
        F.concat(F.lit("city "), draw(cluster, "city", 500).cast("string")).alias(
            "customer_city"
        ),
        F.lit(FRAUD_SOURCE).alias("data_source"),
    )
    return _ordered(people)


def order_facts(customers: DataFrame) -> DataFrame:
    """One to three orders per synthetic customer, each with its items nested.

    Items stay inside their order row, so the payment total needs no shuffle.
    """
    owner = F.col("customer_id")
    numbered = (
        customers.where(F.col("is_synthetic"))
        .select(
            owner,
            F.explode(F.sequence(F.lit(1), draw(owner, "orders", 3).cast("int") + 1)).alias(
                "order_no"
            ),
        )
        .select(
            owner,
            F.md5(F.concat(owner, F.lit("#"), F.col("order_no").cast("string"))).alias(
                "order_id"
            ),
        )
    )
    key = F.col("order_id")
    purchased = _later(
        "SECOND", draw(key, "purchase", PURCHASE_SECONDS), _moment(FIRST_PURCHASE)
    )
    dated = numbered.select(
        "*", pick_weighted(STATUSES, key, "status").alias("order_status"), purchased.alias("bought")
    )

    def item(number: Column) -> Column:
        part = F.concat(key, F.lit("#"), number.cast("string"))
        return F.struct(
            number.alias("order_item_id"),
            F.md5(F.concat(part, F.lit("/product"))).alias("product_id"),
            F.md5(F.concat(part, F.lit("/seller"))).alias("seller_id"),
            _money(part, "price", 2000, 50000).alias("price"),
            _money(part, "freight", 500, 5000).alias("freight_value"),
        )

    return dated.select(
        "*",
        F.when(
            F.col("order_status") == DELIVERED,
            _later("DAY", draw(key, "delivery", 43) + 3, F.col("bought")),
        ).alias("arrived"),
        F.transform(
            F.sequence(F.lit(1), draw(key, "items", 3).cast("int") + 1), item
        ).alias("items"),
    )


def orders(facts: DataFrame) -> DataFrame:
    """Raw orders of 2019, timestamps as text."""
    key, bought = F.col("order_id"), F.col("bought")
    moments = {
        "order_purchase_timestamp": bought,
        "order_approved_at": _later("HOUR", draw(key, "approval", 48) + 1, bought),
        "order_delivered_carrier_date": _later("DAY", draw(key, "carrier", 5) + 1, bought),
        "order_delivered_customer_date": F.col("arrived"),
        "order_estimated_delivery_date": _later(
            "DAY", draw(key, "estimate", 24) + 7, bought
        ),
    }
    return facts.select(
        "order_id",
        "customer_id",
        "order_status",
        *[moment.cast("string").alias(name) for name, moment in moments.items()],
    )


def order_items(facts: DataFrame) -> DataFrame:
    """One to three items per order; to be shipped within three days."""
    limit = _later("DAY", F.lit(3), F.col("bought")).cast("string")
    return facts.select("order_id", limit.alias("limit"), F.inline("items")).select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        F.col("limit").alias("shipping_limit_date"),
        "price",
        "freight_value",
    )


def order_payments(facts: DataFrame) -> DataFrame:
    """One payment per order over its item prices, freight excluded."""
    key = F.col("order_id")
    total = F.aggregate("items", F.lit(0.0), lambda sum_, item: sum_ + item["price"])
    paid = facts.select(
        key, pick_weighted(PAYMENT_TYPES, key, "payment").alias("payment_type"), total.alias("total")
    )
    by_card = F.col("payment_type") == "credit_card"
    return paid.select(
        key,
        F.lit(1).alias("payment_sequential"),
        "payment_type",
        F.when(by_card, (draw(key, "installments", 12) + 1).cast("int"))
        .otherwise(1)
        .alias("payment_installments"),
        half_up(F.col("total"), 2).alias("payment_value"),
    )


def order_reviews(facts: DataFrame) -> DataFrame:
    """One review per delivered order, mostly good ones."""
    key, arrived = F.col("order_id"), F.col("arrived")
    luck = draw(key, "score", 100)
    score = None
    for below, stars in SCORE_BELOW.items():
        score = F.when(luck < below, stars) if score is None else score.when(luck < below, stars)
    return facts.where(arrived.isNotNull()).select(
        F.md5(F.concat(key, F.lit("/review"))).alias("review_id"),
        key,
        score.otherwise(5).alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        _later("DAY", draw(key, "created", 7) + 1, arrived)
        .cast("string")
        .alias("review_creation_date"),
        _later("DAY", draw(key, "answered", 9) + 2, arrived)
        .cast("string")
        .alias("review_answer_timestamp"),
    )
