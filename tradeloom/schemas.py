"""Declared schemas: raw tables and the contracts of staging and mart models.

Schemas are DDL text, parsed on first use (parsing needs a running session).
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Raw layer. Timestamps land as text and are parsed by the staging model.
RAW_DDL = {
    "orders": """
        order_id string, customer_id string, order_status string,
        order_purchase_timestamp string, order_approved_at string,
        order_delivered_carrier_date string, order_delivered_customer_date string,
        order_estimated_delivery_date string""",
    "order_items": """
        order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date string, price double, freight_value double""",
    "order_payments": """
        order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value double""",
    "order_reviews": """
        review_id string, order_id string, review_score int,
        review_comment_title string, review_comment_message string,
        review_creation_date string, review_answer_timestamp string""",
    "customers": "customer_id string, customer_city string, customer_state string",
    "sellers": "seller_id string, seller_city string, seller_state string",
    "products": "product_id string, product_category_name string",
    "translation": """
        product_category_name string, product_category_name_english string""",
    "geolocation": """
        geolocation_zip_code_prefix string, geolocation_city string,
        geolocation_state string""",
    "customers_extended": """
        customer_id string, full_name string, email string, phone string,
        document_number string, credit_card_token string, credit_card_last4 string,
        lgpd_accepted boolean, lgpd_accepted_at timestamp_ntz,
        marketing_opt_in boolean, marketing_opt_in_at timestamp_ntz,
        customer_state string, customer_city string, created_at timestamp_ntz,
        is_synthetic boolean, data_source string""",
}

# The nine tables a source system delivers; the tenth is made by the synthetic job.
SOURCE_TABLES = [name for name in RAW_DDL if name != "customers_extended"]

# Text length limits of the extended customer table, checked as data quality.
TEXT_LIMITS = {
    "customer_id": 255,
    "full_name": 255,
    "email": 255,
    "phone": 20,
    "document_number": 11,
    "credit_card_token": 64,
    "credit_card_last4": 4,
    "customer_state": 2,
    "customer_city": 255,
    "data_source": 50,
}

STAGING_DDL = {
    "stg_orders": """
        ORDER_ID string, CUSTOMER_ID string, ORDER_STATUS string,
        ORDER_PURCHASED_AT timestamp_ntz, ORDER_APPROVED_AT timestamp_ntz,
        ORDER_SHIPPED_AT timestamp_ntz, ORDER_DELIVERED_AT timestamp_ntz,
        ORDER_ESTIMATED_AT timestamp_ntz, ORDER_MONTH timestamp_ntz,
        ORDER_HOUR timestamp_ntz, ORDER_DAY_OF_WEEK int, ORDER_HOUR_OF_DAY int""",
}

MART_DDL = {
    "mart_sazonalidade": """
        MES timestamp_ntz, ANO int, NUMERO_MES int, TOTAL_PEDIDOS bigint,
        PEDIDOS_ENTREGUES bigint, PEDIDOS_CANCELADOS bigint,
        TAXA_CANCELAMENTO_PCT double""",
    "mart_clientes_top": """
        CUSTOMER_ID string, CIDADE string, ESTADO string, TOTAL_PEDIDOS bigint,
        VALOR_TOTAL_GASTO double, TICKET_MEDIO double,
        PRIMEIRA_COMPRA timestamp_ntz, ULTIMA_COMPRA timestamp_ntz""",
    "mart_horarios_pico": """
        HORA_DO_DIA int, DIA_DA_SEMANA int, TOTAL_PEDIDOS bigint,
        MEDIA_DIAS_ENTREGA double""",
    "mart_perfil_cliente": """
        ESTADO string, CIDADE string, TOTAL_CLIENTES bigint, TOTAL_PEDIDOS bigint,
        TICKET_MEDIO double, RECEITA_TOTAL double, PAGAMENTO_PREFERIDO string""",
    "mart_top_categories": """
        CATEGORY string, TOTAL_ORDERS bigint, UNIQUE_PRODUCTS bigint,
        TOTAL_REVENUE double, AVG_PRICE double, REVENUE_SHARE_PCT double""",
    "mart_revenue_trend": """
        YEAR int, MONTH int, MONTH_NAME string, MONTH_DATE timestamp_ntz,
        TOTAL_ORDERS bigint, TOTAL_REVENUE double, AVG_ORDER_VALUE double,
        REVENUE_DIFF_PREV_MONTH double""",
    "mart_ticket_by_category": """
        CATEGORY string, TOTAL_ORDERS bigint, TOTAL_REVENUE double,
        AVG_ITEM_PRICE double, MIN_PRICE double, MAX_PRICE double""",
    "mart_customer_profile_by_state": """
        STATE string, TOTAL_CUSTOMERS bigint, TOTAL_ORDERS bigint,
        AVG_LIFETIME_VALUE double, MAX_LIFETIME_VALUE double,
        MIN_LIFETIME_VALUE double, TOTAL_REVENUE double,
        AVG_ORDERS_PER_CUSTOMER double, REVENUE_SHARE_PCT double""",
    "mart_delivery_time_by_state": """
        STATE string, TOTAL_ORDERS bigint, AVG_DELIVERY_DAYS double,
        MIN_DELIVERY_DAYS double, MAX_DELIVERY_DAYS double,
        AVG_ESTIMATED_DAYS double""",
    "mart_late_deliveries": """
        YEAR int, MONTH int, MONTH_NAME string, TOTAL_ORDERS bigint,
        LATE_ORDERS bigint, ON_TIME_ORDERS bigint, LATE_RATE_PCT double,
        AVG_DAYS_LATE double""",
    "mart_delay_by_category": """
        CATEGORY string, TOTAL_ORDERS bigint, LATE_ORDERS bigint,
        LATE_RATE_PCT double, AVG_DELIVERY_DAYS double""",
    "mart_top_sellers": """
        SELLER_ID string, CITY string, STATE string, TOTAL_ORDERS bigint,
        UNIQUE_PRODUCTS bigint, TOTAL_REVENUE double, AVG_ITEM_PRICE double,
        REVENUE_SHARE_PCT double""",
    "mart_reviews_by_category": """
        CATEGORY string, TOTAL_ORDERS bigint, AVG_SCORE double, FIVE_STAR bigint,
        ONE_STAR bigint, NEGATIVE_RATE_PCT double, POSITIVE_RATE_PCT double""",
    "mart_seasonality": """
        YEAR int, MONTH int, MONTH_NAME string, MONTH_DATE timestamp_ntz,
        TOTAL_ORDERS bigint, TOTAL_REVENUE double, AVG_ORDER_VALUE double,
        MONTHLY_SHARE_PCT double""",
    "mart_peak_hours": """
        DAY_NUMBER int, DAY_NAME string, HOUR_OF_DAY int, TOTAL_ORDERS bigint,
        HOUR_SHARE_PCT double""",
    "mart_top_category_by_month": """
        YEAR int, MONTH int, MONTH_NAME string, TOP_CATEGORY string,
        TOTAL_ORDERS bigint, TOTAL_REVENUE double""",
    "mart_seasonal_dates": """
        ORDER_DATE timestamp_ntz, TOTAL_ORDERS bigint, TOTAL_REVENUE double,
        DATE_TYPE string""",
    "mart_fraud_signals": """
        CUSTOMER_ID string, FULL_NAME string, EMAIL string,
        CREDIT_CARD_TOKEN string, CREDIT_CARD_LAST4 string, CUSTOMER_STATE string,
        CUSTOMER_CITY string, FRAUD_TYPE string, RISK_LEVEL string,
        CUSTOMERS_SHARING_CARD bigint, DIFFERENT_NAMES bigint, NAMES_LIST string,
        IS_SYNTHETIC boolean, DATA_SOURCE string, DETECTED_AT timestamp""",
}


def raw_schema(name: str) -> StructType:
    return StructType.fromDDL(RAW_DDL[name])


def contract(name: str) -> StructType:
    """Declared names and types of a staging or mart model."""
    return StructType.fromDDL({**STAGING_DDL, **MART_DDL}[name])
