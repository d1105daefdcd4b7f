"""All models by name: builder, contract and declared checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tradeloom.operators.quality import Checks
from tradeloom.plans import customers, delivery, fraud, reviews, sales, seasonality, sellers
from tradeloom.sources.tables import Tables

Builder = Callable[[Tables], DataFrame]

STAGING: dict[str, Builder] = {"stg_orders": lambda t: t.stg_orders}

MARTS: dict[str, Builder] = {
    "mart_sazonalidade": seasonality.monthly_orders,
    "mart_clientes_top": customers.customers_by_spend,
    "mart_horarios_pico": seasonality.order_hours,
    "mart_perfil_cliente": customers.profile_by_city,
    "mart_top_categories": sales.top_categories,
    "mart_revenue_trend": sales.revenue_trend,
    "mart_ticket_by_category": sales.ticket_by_category,
    "mart_customer_profile_by_state": customers.profile_by_state,
    "mart_delivery_time_by_state": delivery.delivery_time_by_state,
    "mart_late_deliveries": delivery.late_deliveries,
    "mart_delay_by_category": delivery.delay_by_category,
    "mart_top_sellers": sellers.top_sellers,
    "mart_reviews_by_category": reviews.reviews_by_category,
    "mart_seasonality": seasonality.seasonality,
    "mart_peak_hours": seasonality.peak_hours,
    "mart_top_category_by_month": seasonality.top_category_by_month,
    "mart_seasonal_dates": seasonality.seasonal_dates,
    "mart_fraud_signals": fraud.fraud_signals,
}

ANALYSES: dict[str, Builder] = {
    "a01_top_categories_by_revenue": sales.top_categories,
    "a02_monthly_revenue_trend": sales.revenue_trend_report,
    "a03_cancellation_rate_by_category": sales.cancellation_rate_by_category,
    "a04_avg_ticket_by_category": sales.ticket_report,
    "a05_pareto_revenue_by_category": sales.pareto_by_category,
    "a06_payment_method_by_state": sales.payment_method_by_state,
    "a07_installments_by_category": sales.installments_by_category,
    "a08_single_purchase_customers": customers.single_purchase_customers,
    "a09_customers_above_avg_ticket": customers.customers_above_mean,
    "a10_top_customers_geographic_profile": customers.geographic_profile,
    "a11_lifetime_value_by_state": customers.lifetime_value_by_state,
    "a12_recurring_vs_unique_customers": customers.recurring_customers,
    "a13_avg_delivery_time_by_state": delivery.delivery_time_report,
    "a14_late_deliveries_vs_estimated": delivery.late_deliveries_report,
    "a15_delay_rate_by_state": delivery.delay_rate_by_state,
    "a16_delay_rate_by_category": delivery.delay_by_category_report,
    "a17_delay_vs_review_score": delivery.delay_vs_review,
    "a18_top_sellers_by_revenue": sellers.top_sellers,
    "a19_sellers_with_highest_delay": sellers.sellers_with_highest_delay,
    "a20_sellers_best_reviews": sellers.sellers_best_reviews,
    "a21_active_sellers_by_state": sellers.active_sellers_by_state,
    "a22_review_score_distribution": reviews.score_distribution,
    "a23_worst_reviewed_categories": reviews.worst_reviewed_categories,
    "a24_delivery_time_vs_review": reviews.delivery_time_vs_review,
    "a25_seller_response_time_vs_review": reviews.response_time_vs_review,
    "a26_annual_monthly_seasonality": seasonality.seasonality_report,
    "a27_peak_hours_by_weekday": seasonality.peak_hours_report,
    "a28_top_category_by_month": seasonality.top_category_report,
    "a29_black_friday_seasonal_dates": seasonality.busiest_days,
}

FRAUD_RULES: dict[str, Builder] = {
    "fraud_shared_card": fraud.shared_cards,
    "fraud_negative_payments": fraud.negative_payments,
    "fraud_invalid_dates": fraud.invalid_dates,
    "fraud_customers": fraud.fraud_customers,
    "fraud_signals_all": fraud.all_signals,
}

# Domains the declared checks accept.
ORDER_STATUSES = [
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
]
MONTH_NUMBERS = list(range(1, 13))
DATE_TYPES = [*seasonality.COMMERCIAL_DATES, seasonality.ORDINARY_DATE]
FRAUD_TYPES = [fraud.SHARED_CARD, fraud.NEGATIVE_PAYMENT, fraud.EARLY_DELIVERY]
RISK_LEVELS = [*fraud.CARD_RISK, fraud.LOWEST_RISK]

_by_category = Checks(not_null=["CATEGORY"], unique=["CATEGORY"])
_by_state = Checks(not_null=["STATE"], unique=["STATE"])
_by_month = Checks(not_null=["YEAR", "MONTH"], accepted={"MONTH": MONTH_NUMBERS})
_by_dated_month = Checks(
    not_null=["YEAR", "MONTH", "MONTH_DATE"],
    unique=["MONTH_DATE"],
    accepted={"MONTH": MONTH_NUMBERS},
)

STAGING_CHECKS = {
    "stg_orders": Checks(
        not_null=["ORDER_ID", "CUSTOMER_ID"],
        unique=["ORDER_ID"],
        accepted={"ORDER_STATUS": ORDER_STATUSES},
    ),
}

MART_CHECKS = {
    "mart_sazonalidade": Checks(
        not_null=["MES"], unique=["MES"], accepted={"NUMERO_MES": MONTH_NUMBERS}
    ),
    "mart_clientes_top": Checks(not_null=["CUSTOMER_ID"], unique=["CUSTOMER_ID"]),
    "mart_horarios_pico": Checks(not_null=["HORA_DO_DIA", "DIA_DA_SEMANA"]),
    "mart_perfil_cliente": Checks(not_null=["ESTADO", "CIDADE"]),
    "mart_top_categories": Checks(
        not_null=["CATEGORY", "TOTAL_ORDERS"], unique=["CATEGORY"]
    ),
    "mart_revenue_trend": _by_dated_month,
    "mart_ticket_by_category": _by_category,
    "mart_customer_profile_by_state": _by_state,
    "mart_delivery_time_by_state": _by_state,
    "mart_late_deliveries": _by_month,
    "mart_delay_by_category": _by_category,
    "mart_top_sellers": Checks(not_null=["SELLER_ID"], unique=["SELLER_ID"]),
    "mart_reviews_by_category": _by_category,
    "mart_seasonality": _by_dated_month,
    "mart_peak_hours": Checks(not_null=["DAY_NUMBER", "HOUR_OF_DAY"]),
    "mart_top_category_by_month": _by_month,
    "mart_seasonal_dates": Checks(
        not_null=["ORDER_DATE", "DATE_TYPE"], accepted={"DATE_TYPE": DATE_TYPES}
    ),
    "mart_fraud_signals": Checks(
        not_null=["CUSTOMER_ID", "FRAUD_TYPE", "RISK_LEVEL", "DETECTED_AT"],
        accepted={"FRAUD_TYPE": FRAUD_TYPES, "RISK_LEVEL": RISK_LEVELS},
    ),
}

ALL_CHECKS = {**STAGING_CHECKS, **MART_CHECKS}
