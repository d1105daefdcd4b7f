"""Hand-computed answers on tiny tables, one per rule that is easy to get wrong."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from shop import Shop, by, rows

from tradeloom.operators.staging import stage_orders
from tradeloom.plans import customers, delivery, fraud, reviews, sales, seasonality, sellers


def test_staging_parses_and_derives(spark):
    shop = Shop(spark).order("o1", bought="2020-01-05 23:59:59")
    (row,) = rows(shop.tables().stg_orders)
    assert row["ORDER_PURCHASED_AT"] == dt.datetime(2020, 1, 5, 23, 59, 59)
    assert row["ORDER_MONTH"] == dt.datetime(2020, 1, 1)
    assert row["ORDER_HOUR"] == dt.datetime(2020, 1, 5, 23)
    assert (row["ORDER_DAY_OF_WEEK"], row["ORDER_HOUR_OF_DAY"]) == (0, 23)
    assert row["ORDER_DELIVERED_AT"] is None


def test_malformed_time_text_fails_or_becomes_null(spark):
    raw = Shop(spark).order("o1", bought="not a time").tables().orders
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        stage_orders(raw).collect()
    assert stage_orders(raw, strict=False).first()["ORDER_PURCHASED_AT"] is None


def test_category_falls_back_and_share_is_of_all_categories(spark):
    shop = Shop(spark).translate("livros", "books")
    for product, category in [("p1", "livros"), ("p2", "brinquedos"), ("p3", None)]:
        shop.product(product, category)
    shop.order("o1").order("o2").order("o3", status="canceled")
    shop.item("o1", "p1", 50.0).item("o1", "p1", 20.0).item("o1", "p2", 20.0)
    shop.item("o2", "p3", 10.0).item("o3", "p3", 999.0).item("o2", "p-missing", 999.0)
    found = by(sales.top_categories(shop.tables(), limit=2), "CATEGORY")
    assert set(found) == {"books", "brinquedos"}
    assert found["books"] == {
        "CATEGORY": "books",
        "TOTAL_ORDERS": 1,
        "UNIQUE_PRODUCTS": 1,
        "TOTAL_REVENUE": 70.0,
        "AVG_PRICE": 35.0,
        "REVENUE_SHARE_PCT": 70.0,
    }
    full = by(sales.top_categories(shop.tables()), "CATEGORY")
    assert full["unknown"]["REVENUE_SHARE_PCT"] == 10.0


def test_pareto_runs_up_to_hundred(spark):
    shop = Shop(spark).order("o1")
    for name, price in [("a", 50.0), ("b", 30.0), ("c", 15.0), ("d", 5.0)]:
        shop.product(name, name).item("o1", name, price)
    report = rows(sales.pareto_by_category(shop.tables()))
    assert [r["CUMULATIVE_SHARE_PCT"] for r in report] == [50.0, 80.0, 95.0, 100.0]


def test_revenue_change_skips_missing_months_and_orders_count_once(spark):
    shop = Shop(spark)
    for order, month, value in [("o1", 1, 10.0), ("o2", 2, 25.5), ("o3", 4, 20.0)]:
        shop.order(order, bought=f"2020-0{month}-10 10:00:00").pay(order, value)
    shop.pay("o1", 5.0, "voucher")
    report = rows(sales.revenue_trend_report(shop.tables()))
    assert [r["MONTH"] for r in report] == [1, 2, 4]
    assert [r["TOTAL_ORDERS"] for r in report] == [1, 1, 1]
    assert [r["AVG_ORDER_VALUE"] for r in report] == [7.5, 25.5, 20.0]
    assert [r["REVENUE_DIFF_PREV_MONTH"] for r in report] == [None, 10.5, -5.5]


def test_threshold_is_inclusive_and_rate_may_be_zero(spark):
    shop = Shop(spark).product("p1", "hundred").product("p2", "ninety-nine")
    for i in range(100):
        shop.order(f"o{i}").item(f"o{i}", "p1")
        if i:
            shop.item(f"o{i}", "p2")
    (row,) = rows(sales.cancellation_rate_by_category(shop.tables()))
    assert (row["CATEGORY"], row["TOTAL_ORDERS"]) == ("hundred", 100)
    assert row["CANCELLATION_RATE_PCT"] == 0.0


def test_installments_weigh_by_item_rows_without_pairing(spark):
    """Averages equal those over all (item, payment) pairs of an order."""
    shop = Shop(spark).product("p1", "a")
    for i in range(100):
        order = f"o{i}"
        shop.order(order)
        for _ in range(1 + i % 3):
            shop.item(order, "p1")
        shop.pay(order, 100.0 + i, installments=1 + i % 5)
        if i % 2:
            shop.pay(order, 10.0, installments=12)
    pairs = [
        (1 + i % 5, 100.0 + i) for i in range(100) for _ in range(1 + i % 3)
    ] + [(12, 10.0) for i in range(100) if i % 2 for _ in range(1 + i % 3)]
    (row,) = rows(sales.installments_by_category(shop.tables()))
    assert row["TOTAL_ORDERS"] == 100 and row["MAX_INSTALLMENTS"] == 12
    assert row["AVG_INSTALLMENTS"] == round(sum(p[0] for p in pairs) / len(pairs), 1)
    assert row["AVG_ORDER_VALUE"] == round(sum(p[1] for p in pairs) / len(pairs), 2)


def test_payment_share_within_state(spark):
    shop = Shop(spark).customer("c1", state="SP").customer("c2", state="RJ")
    for i, kind in enumerate(["boleto", "boleto", "voucher", "credit_card"]):
        shop.order(f"o{i}", "c1").pay(f"o{i}", 1.0, kind)
    shop.order("x", "c2").pay("x", 1.0, "boleto")
    shares = {
        (r["STATE"], r["PAYMENT_METHOD"]): r["PAYMENT_SHARE_PCT"]
        for r in rows(sales.payment_method_by_state(shop.tables()))
    }
    assert shares[("SP", "boleto")] == 50.0 and shares[("RJ", "boleto")] == 100.0


def two_order_customers(spark):
    shop = Shop(spark).customer("c1").customer("c2")
    shop.order("o1", "c1").order("o2", "c1").order("o3", "c2").order("o4", "c9")
    shop.pay("o1", 10.0).pay("o1", 20.0, "voucher").pay("o2", 30.0).pay("o3", 40.0)
    return shop.pay("o4", 5.0)


def test_spend_counts_payment_rows_and_keeps_unknown_customers(spark):
    found = by(customers.customers_by_spend(two_order_customers(spark).tables()), "CUSTOMER_ID")
    assert found["c1"]["TOTAL_PEDIDOS"] == 3 and found["c1"]["VALOR_TOTAL_GASTO"] == 60.0
    assert found["c9"]["CIDADE"] is None and found["c9"]["VALOR_TOTAL_GASTO"] == 5.0


def test_city_profile_drops_unknown_customers_and_breaks_ties(spark):
    shop = two_order_customers(spark).pay("o3", 1.0, "voucher").pay("o3", 1.0, "boleto")
    shop.pay("o2", 1.0, "boleto").pay("o2", 1.0, "boleto")
    (row,) = rows(customers.profile_by_city(shop.tables()))
    assert (row["TOTAL_CLIENTES"], row["TOTAL_PEDIDOS"]) == (2, 8)
    assert row["PAGAMENTO_PREFERIDO"] == "boleto"  # three each of boleto, credit_card


def test_state_profile_repeats_value_per_order_but_others_do_not(spark):
    t = two_order_customers(spark).order("o5", "c1").tables()  # o5 has no payment
    (state,) = rows(customers.profile_by_state(t))
    assert state["TOTAL_CUSTOMERS"] == 2 and state["TOTAL_ORDERS"] == 4
    assert state["TOTAL_REVENUE"] == 60.0 * 3 + 40.0
    assert state["AVG_LIFETIME_VALUE"] == 55.0
    assert state["AVG_ORDERS_PER_CUSTOMER"] == 1.8  # (2 * 3 + 1) / 4, rounded up
    (geo,) = rows(customers.geographic_profile(t))
    assert geo["TOTAL_REVENUE"] == 100.0 and geo["AVG_LIFETIME_VALUE"] == 50.0
    (value,) = rows(customers.lifetime_value_by_state(t))
    assert (value["MAX_LTV"], value["MIN_LTV"], value["AVG_ORDERS"]) == (60.0, 40.0, 1.5)


def test_recurring_and_above_mean(spark):
    t = two_order_customers(spark).tables()
    (row,) = rows(customers.recurring_customers(t))
    assert (row["ONE_TIME_BUYERS"], row["RECURRING_BUYERS"]) == (1, 1)
    assert row["RECURRING_RATE_PCT"] == 50.0
    (mean,) = rows(customers.customers_above_mean(t))
    assert mean == {
        "GLOBAL_AVG_TICKET": 21.67,  # (20 + 40 + 5) / 3
        "TOTAL_CUSTOMERS": 3,
        "CUSTOMERS_ABOVE_AVG": 1,
        "CUSTOMERS_BELOW_AVG": 2,
        "PCT_ABOVE_AVG": 33.33,
    }


def test_single_purchase_needs_fifty_customers(spark):
    shop = Shop(spark)
    for i in range(50):
        shop.customer(f"c{i}", "Big").order(f"o{i}", f"c{i}")
        if i:
            shop.customer(f"d{i}", "Small").order(f"d{i}", f"d{i}")
    shop.order("again", "c0")
    (row,) = rows(customers.single_purchase_customers(shop.tables()))
    assert (row["CITY"], row["SINGLE_PURCHASE_CUSTOMERS"], row["TOTAL_CUSTOMERS"]) == (
        "Big",
        49,
        50,
    )
    assert row["CHURN_RATE_PCT"] == 98.0


def delays(spark, days, scores=None):
    """One order per delay against a fixed promise."""
    shop = Shop(spark).customer("c1")
    promise = dt.datetime(2020, 2, 1)
    for i, day in enumerate(days):
        shop.order(
            f"o{i}",
            delivered=str(promise + dt.timedelta(days=day)),
            estimated=str(promise),
            bought="2020-01-01 08:00:00",
        )
        shop.review(f"o{i}", scores[i] if scores else 5)
    return shop


def test_delay_buckets(spark):
    days = [-8, -7, -6, -1, 0, 1, 7, 8]
    found = by(delivery.delay_vs_review(delays(spark, days).tables()), "DELIVERY_STATUS")
    assert {k: v["TOTAL_ORDERS"] for k, v in found.items()} == {
        "very early (7+ days before)": 2,
        "early (1-6 days before)": 2,
        "on time": 1,
        "late (1-7 days)": 2,
        "very late (7+ days)": 1,
    }


def test_lateness_means_differ_by_report(spark):
    t = delays(spark, [-4, 2, 4]).tables()
    (month,) = rows(delivery.late_deliveries(t))
    assert (month["LATE_ORDERS"], month["ON_TIME_ORDERS"]) == (2, 1)
    assert month["LATE_RATE_PCT"] == 66.67 and month["AVG_DAYS_LATE"] == 0.7
    (state,) = rows(delivery.delay_rate_by_state(t))
    assert state["AVG_DAYS_LATE"] == 3.0


def test_delivery_time_buckets(spark):
    shop = Shop(spark)
    for i, days in enumerate([3, 4, 7, 8, 14, 15, 21, 22]):
        arrived = dt.datetime(2020, 1, 1, 1) + dt.timedelta(days=days)
        shop.order(f"o{i}", bought="2020-01-01 23:00:00", delivered=str(arrived))
        shop.review(f"o{i}", 4 if i else 1)
    found = by(reviews.delivery_time_vs_review(shop.tables()), "DELIVERY_RANGE")
    assert {k: v["TOTAL_ORDERS"] for k, v in found.items()} == {
        "1-3 days": 1,
        "4-7 days": 2,
        "8-14 days": 2,
        "15-21 days": 2,
        "22+ days": 1,
    }
    assert found["1-3 days"]["POSITIVE_RATE_PCT"] == 0.0


def test_answer_time_buckets(spark):
    shop = Shop(spark)
    for i, days in enumerate([0, 1, 3, 4, 7, 8]):
        answered = dt.datetime(2020, 1, 1) + dt.timedelta(days=days)
        shop.order(f"o{i}").review(f"o{i}", 5, "2020-01-01 00:00:00", str(answered))
    shop.order("open").review("open", 1, "2020-01-01 00:00:00", None)
    found = by(reviews.response_time_vs_review(shop.tables()), "RESPONSE_TIME")
    assert {k: v["TOTAL_REVIEWS"] for k, v in found.items()} == {
        "same day": 1,
        "1-3 days": 2,
        "4-7 days": 2,
        "7+ days": 1,
    }


def test_reviews_weigh_by_item_rows_without_pairing(spark):
    shop, pairs = Shop(spark).product("p1", "a").seller("s1"), []
    for i in range(100):
        shop.order(f"o{i}")
        for _ in range(1 + i % 4):
            shop.item(f"o{i}", "p1")
        scores = [1 + i % 5] + ([5] if i % 3 == 0 else [])
        for n, score in enumerate(scores):
            shop.review(f"o{i}", score, review_id=f"r{i}-{n}")
            pairs += [score] * (1 + i % 4)
    mean = round(sum(pairs) / len(pairs) + 1e-9, 2)
    (category,) = rows(reviews.reviews_by_category(shop.tables()))
    assert category["AVG_SCORE"] == mean and category["TOTAL_ORDERS"] == 100
    assert category["ONE_STAR"] == 20
    five = len({i for i in range(100) if i % 5 == 4 or i % 3 == 0})
    assert category["FIVE_STAR"] == five
    (seller,) = rows(sellers.sellers_best_reviews(shop.tables()))
    assert seller["AVG_REVIEW_SCORE"] == mean and seller["FIVE_STAR_ORDERS"] == five


def test_sellers_need_thirty_orders(spark):
    shop = Shop(spark).seller("s1").seller("s2")
    for i in range(30):
        shop.order(f"o{i}", delivered="2020-02-02 00:00:00", estimated="2020-02-01 00:00:00")
        shop.item(f"o{i}", seller_id="s1")
        if i:
            shop.item(f"o{i}", seller_id="s2")
    (row,) = rows(sellers.sellers_with_highest_delay(shop.tables()))
    assert (row["SELLER_ID"], row["LATE_RATE_PCT"], row["AVG_DAYS_LATE"]) == ("s1", 100.0, 1.0)


def test_sellers_by_state_count_sellers_and_orders_once(spark):
    shop = Shop(spark).seller("s1").seller("s2").seller("s3", state="RJ")
    shop.order("o1").order("o2")
    shop.item("o1", seller_id="s1").item("o1", "p2", seller_id="s1").item("o1", seller_id="s2")
    shop.item("o2", seller_id="s1").item("o2", seller_id="s3")
    found = by(sellers.active_sellers_by_state(shop.tables()), "STATE")
    assert (found["SP"]["ACTIVE_SELLERS"], found["SP"]["TOTAL_ORDERS"]) == (2, 2)
    assert found["SP"]["ORDERS_PER_SELLER"] == 1.0 and found["RJ"]["TOTAL_ORDERS"] == 1


def test_commercial_dates_match_in_any_year(spark):
    days = {
        "11-24": "Black Friday 2017",
        "11-23": "Black Friday 2018",
        "12-24": "Christmas",
        "12-25": "Christmas",
        "01-01": "New Year",
        "01-02": "New Year",
        "02-12": "Valentines",
        "02-14": "Valentines",
        "05-13": "Mothers Day",
        "05-14": "Mothers Day",
        "07-07": "regular day",
    }
    moments = [(f"{year}-{day} 00:00:00", label) for year in (2016, 2021) for day, label in days.items()]
    df = spark.createDataFrame(moments, "day string, label string")
    wrong = df.where(seasonality.date_label(F.col("day").cast("timestamp_ntz")) != F.col("label"))
    assert wrong.count() == 0


def test_best_category_ties_go_to_the_smaller_name(spark):
    shop = Shop(spark).product("p1", "b").product("p2", "a").order("o1")
    shop.item("o1", "p1", 10.0).item("o1", "p2", 10.0)
    (row,) = rows(seasonality.top_category_by_month(shop.tables()))
    assert row["TOP_CATEGORY"] == "a"


def test_card_risk_levels(spark):
    shop = Shop(spark)
    for token, size in {"t2": 2, "t4": 4, "t5": 5, "t9": 9, "t10": 10, "t1": 1}.items():
        for i in range(size):
            shop.person(f"{token}-{i}", f"{token} name {i // 2}", token)
    for i in range(3):
        shop.person(f"null-{i}", "x", None)
    found = rows(fraud.fraud_signals(shop.tables(), "2026-01-01 00:00:00"))
    levels = {r["CREDIT_CARD_TOKEN"]: r["RISK_LEVEL"] for r in found}
    assert levels == {
        "t2": "medium",
        "t4": "medium",
        "t5": "high",
        "t9": "high",
        "t10": "critical",
    }
    assert len(found) == 30
    four = by(fraud.shared_cards(shop.tables()), "CREDIT_CARD_TOKEN")["t4"]
    assert (four["DIFFERENT_NAMES"], four["NAMES_LIST"]) == (2, "t4 name 0 | t4 name 1")


def test_card_on_two_rows_of_one_customer_is_not_shared(spark):
    shop = Shop(spark).person("c1", "n", "t").person("c1", "n", "t")
    shop.person("c2", None, "u").person("c3", None, "u")
    (card,) = rows(fraud.shared_cards(shop.tables()))
    assert card["CREDIT_CARD_TOKEN"] == "u"
    assert (card["DIFFERENT_NAMES"], card["NAMES_LIST"]) == (0, None)
    assert len(rows(fraud.fraud_customers(shop.tables()))) == 2


def test_other_fraud_rules(spark):
    shop = Shop(spark).order("o1", bought="2020-01-02 00:00:00", delivered="2020-01-01 00:00:00")
    shop.order("o2", delivered=None).pay("o1", -1.0).pay("o2", 0.0)
    t = shop.tables()
    assert [r["ORDER_ID"] for r in rows(fraud.invalid_dates(t))] == ["o1"]
    assert [r["ORDER_ID"] for r in rows(fraud.negative_payments(t))] == ["o1"]
    assert {r["FRAUD_TYPE"] for r in rows(fraud.all_signals(t))} == {
        "negative_payment_value",
        "delivery_before_purchase",
    }


def test_repeated_order_rows_are_counted_once(spark):
    """Distinct counts hold when a raw order row was loaded twice."""
    shop = delays(spark, [1, 1])
    shop.rows["orders"] *= 2
    shop.pay("o0", 10.0).pay("o1", 30.0)
    t = shop.tables()
    (month,) = rows(delivery.late_deliveries(t))
    assert (month["TOTAL_ORDERS"], month["LATE_ORDERS"], month["LATE_RATE_PCT"]) == (2, 2, 100.0)
    (trend,) = rows(sales.revenue_trend(t))
    assert (trend["TOTAL_ORDERS"], trend["TOTAL_REVENUE"]) == (2, 80.0)
