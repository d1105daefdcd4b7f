"""Every model as one independent SQL query over the CTEs of `bridge_sql`.

Written in the direct form (distinct counts, joins that repeat rows), so that the
two-step Spark forms are checked against the plain definition.
"""

from __future__ import annotations

DETECTED_AT = "2026-01-01 06:00:00"


def r(expression: str, digits: int = 2) -> str:
    """Half-away-from-zero rounding, as a double."""
    return f"cast(round(cast({expression} as decimal(28, 8)), {digits}) as double)"


def pct(part: str, whole: str) -> str:
    return r(f"cast({part} as double) * 100.0 / nullif(cast({whole} as double), 0.0)")


def top(order: str, limit: int | None) -> str:
    return f"order by {order} limit {limit}" if limit else ""


YEAR, MONTH = "cast(year(bought) as integer)", "cast(month(bought) as integer)"
MONTH_NAME = "strftime(bought, '%b')"
MONTH_DATE = "cast(date_trunc('month', bought) as timestamp)"
ORDERS = "count(distinct oid)"
LATE = "count(distinct oid) filter (late)"
PAID = "done join pay on pay.order_id = oid"
SOLD = "done join goods using (oid)"
SHOP = "sell join items using (seller_id) join {orders} on order_id = oid"


def top_categories() -> str:
    return f"""
        select CATEGORY, {ORDERS} as TOTAL_ORDERS,
            count(distinct product_id) as UNIQUE_PRODUCTS,
            {r("sum(price)")} as TOTAL_REVENUE, {r("avg(price)")} as AVG_PRICE,
            {pct("sum(price)", "sum(sum(price)) over ()")} as REVENUE_SHARE_PCT
        from {SOLD} group by CATEGORY
        order by TOTAL_REVENUE desc, CATEGORY limit 10"""


MONTHLY = f"""
    select {YEAR} as YEAR, {MONTH} as MONTH, {MONTH_NAME} as MONTH_NAME,
        {MONTH_DATE} as MONTH_DATE, {ORDERS} as TOTAL_ORDERS,
        sum(payment_value) as s, avg(payment_value) as a
    from {PAID} group by all"""


def revenue_trend(names: bool) -> str:
    return f"""
        select YEAR, MONTH, {"MONTH_NAME," if names else ""} MONTH_DATE, TOTAL_ORDERS,
            {r("s")} as TOTAL_REVENUE, {r("a")} as AVG_ORDER_VALUE,
            {r("s - lag(s) over (order by MONTH_DATE)")} as REVENUE_DIFF_PREV_MONTH
        from ({MONTHLY})"""


def seasonality(dates: bool) -> str:
    return f"""
        select YEAR, MONTH, MONTH_NAME, {"MONTH_DATE," if dates else ""} TOTAL_ORDERS,
            {r("s")} as TOTAL_REVENUE, {r("a")} as AVG_ORDER_VALUE,
            {pct("s", "sum(s) over (partition by YEAR)")} as MONTHLY_SHARE_PCT
        from ({MONTHLY})"""


def cancellations() -> str:
    gone = "count(distinct oid) filter (status = 'canceled')"
    return f"""
        select CATEGORY, {ORDERS} as TOTAL_ORDERS, {gone} as CANCELED_ORDERS,
            {pct(gone, ORDERS)} as CANCELLATION_RATE_PCT
        from ord join goods using (oid) group by CATEGORY having {ORDERS} >= 100
        order by CANCELLATION_RATE_PCT desc, CATEGORY limit 15"""


def ticket(limit: int | None) -> str:
    return f"""
        select CATEGORY, {ORDERS} as TOTAL_ORDERS, {r("sum(price)")} as TOTAL_REVENUE,
            {r("avg(price)")} as AVG_ITEM_PRICE, {r("min(price)")} as MIN_PRICE,
            {r("max(price)")} as MAX_PRICE
        from {SOLD} group by CATEGORY having {ORDERS} >= 100
        {top("AVG_ITEM_PRICE desc, CATEGORY", limit)}"""


def pareto() -> str:
    running = """sum(TOTAL_REVENUE) over (order by TOTAL_REVENUE desc, CATEGORY
                 rows between unbounded preceding and current row)"""
    whole = "sum(TOTAL_REVENUE) over ()"
    return f"""
        select CATEGORY, TOTAL_REVENUE,
            {pct("TOTAL_REVENUE", whole)} as REVENUE_SHARE_PCT,
            {pct(running, whole)} as CUMULATIVE_SHARE_PCT
        from (select CATEGORY, {r("sum(price)")} as TOTAL_REVENUE
              from {SOLD} group by CATEGORY)"""


def payment_methods() -> str:
    whole = f"sum({ORDERS}) over (partition by customer_state)"
    return f"""
        select customer_state as STATE, payment_type as PAYMENT_METHOD,
            {ORDERS} as TOTAL_ORDERS, {r("sum(payment_value)")} as TOTAL_REVENUE,
            {r("avg(payment_value)")} as AVG_ORDER_VALUE,
            {pct(ORDERS, whole)} as PAYMENT_SHARE_PCT
        from {PAID} join cust on customer_id = cid
        group by customer_state, payment_type"""


def installments() -> str:
    return f"""
        select CATEGORY, {ORDERS} as TOTAL_ORDERS,
            {r("avg(cast(payment_installments as double))", 1)} as AVG_INSTALLMENTS,
            {r("avg(payment_value)")} as AVG_ORDER_VALUE,
            max(payment_installments) as MAX_INSTALLMENTS
        from {SOLD} join pay on pay.order_id = oid
        where payment_type = 'credit_card'
        group by CATEGORY having {ORDERS} >= 100
        order by AVG_INSTALLMENTS desc, CATEGORY limit 15"""


BUYERS = f"select cid, {ORDERS} as orders from done group by cid"
LOYALTY = f"({BUYERS}) join cust on customer_id = cid"


def single_purchase() -> str:
    single = "count(distinct cid) filter (orders = 1)"
    return f"""
        select customer_state as STATE, customer_city as CITY,
            {single} as SINGLE_PURCHASE_CUSTOMERS,
            count(distinct cid) as TOTAL_CUSTOMERS,
            {pct(single, "count(distinct cid)")} as CHURN_RATE_PCT
        from {LOYALTY} group by customer_state, customer_city
        having count(distinct cid) >= 50
        order by CHURN_RATE_PCT desc, STATE, CITY limit 20"""


def recurring() -> str:
    again = "count(distinct cid) filter (orders > 1)"
    return f"""
        select customer_state as STATE, count(distinct cid) as TOTAL_CUSTOMERS,
            count(distinct cid) filter (orders = 1) as ONE_TIME_BUYERS,
            {again} as RECURRING_BUYERS,
            {pct(again, "count(distinct cid)")} as RECURRING_RATE_PCT
        from {LOYALTY} group by customer_state"""


def above_mean() -> str:
    tickets = f"select cid, {r('avg(payment_value)')} as ticket from {PAID} group by cid"
    above = "count(*) filter (ticket > g)"
    return f"""
        select g as GLOBAL_AVG_TICKET, count(*) as TOTAL_CUSTOMERS,
            {above} as CUSTOMERS_ABOVE_AVG,
            count(*) filter (ticket <= g) as CUSTOMERS_BELOW_AVG,
            {pct(above, "count(*)")} as PCT_ABOVE_AVG
        from (select ticket, {r("avg(ticket) over ()")} as g from ({tickets}))
        group by g"""


def _values(amount: str) -> str:
    return f"""(select cid, {amount} as value, {ORDERS} as orders
                from {PAID} group by cid) as worth
               join cust on customer_id = worth.cid"""


def geographic_profile() -> str:
    return f"""
        select customer_state as STATE, count(distinct worth.cid) as TOTAL_CUSTOMERS,
            {r("avg(value)")} as AVG_LIFETIME_VALUE, {r("sum(value)")} as TOTAL_REVENUE,
            {r("avg(orders)", 1)} as AVG_ORDERS_PER_CUSTOMER,
            {pct("sum(value)", "sum(sum(value)) over ()")} as REVENUE_SHARE_PCT
        from {_values(r("sum(payment_value)"))} group by customer_state"""


def lifetime_values() -> str:
    return f"""
        select customer_state as STATE, count(distinct worth.cid) as TOTAL_CUSTOMERS,
            {r("avg(value)")} as AVG_LTV, {r("max(value)")} as MAX_LTV,
            {r("min(value)")} as MIN_LTV, {r("avg(orders)", 1)} as AVG_ORDERS
        from {_values("sum(payment_value)")} group by customer_state"""


def profile_by_state() -> str:
    return f"""
        select customer_state as STATE, count(distinct worth.cid) as TOTAL_CUSTOMERS,
            count(distinct done.oid) as TOTAL_ORDERS,
            {r("avg(value)")} as AVG_LIFETIME_VALUE,
            {r("max(value)")} as MAX_LIFETIME_VALUE,
            {r("min(value)")} as MIN_LIFETIME_VALUE,
            {r("sum(value)")} as TOTAL_REVENUE,
            {r("avg(worth.orders)", 1)} as AVG_ORDERS_PER_CUSTOMER,
            {pct("sum(value)", "sum(sum(value)) over ()")} as REVENUE_SHARE_PCT
        from {_values("sum(payment_value)")} join done on done.cid = worth.cid
        group by customer_state"""


def customers_by_spend() -> str:
    return f"""
        select cid as CUSTOMER_ID, customer_city as CIDADE, customer_state as ESTADO,
            count(oid) as TOTAL_PEDIDOS, {r("sum(payment_value)")} as VALOR_TOTAL_GASTO,
            {r("avg(payment_value)")} as TICKET_MEDIO, min(bought) as PRIMEIRA_COMPRA,
            max(bought) as ULTIMA_COMPRA
        from done left join pay on pay.order_id = oid
            left join cust on customer_id = cid
        group by cid, customer_city, customer_state"""


def profile_by_city() -> str:
    lines = f"""done join cust on customer_id = cid
                left join pay on pay.order_id = oid
                where customer_city is not null and customer_state is not null"""
    return f"""
        select customer_state as ESTADO, customer_city as CIDADE,
            count(distinct cid) as TOTAL_CLIENTES, count(oid) as TOTAL_PEDIDOS,
            {r("avg(payment_value)")} as TICKET_MEDIO,
            {r("sum(payment_value)")} as RECEITA_TOTAL,
            max(favourite) as PAGAMENTO_PREFERIDO
        from (select * from {lines}) left join (
            select customer_state as s, customer_city as c, payment_type as favourite
            from {lines} and payment_type is not null
            group by s, c, favourite
            qualify row_number() over (partition by s, c
                order by count(*) desc, favourite) = 1)
            on s = customer_state and c = customer_city
        group by customer_state, customer_city"""


def monthly_orders() -> str:
    return f"""
        select order_month as MES, cast(year(order_month) as integer) as ANO,
            cast(month(order_month) as integer) as NUMERO_MES,
            count(oid) as TOTAL_PEDIDOS,
            count(*) filter (status = 'delivered') as PEDIDOS_ENTREGUES,
            count(*) filter (status = 'canceled') as PEDIDOS_CANCELADOS,
            {pct("count(*) filter (status = 'canceled')", "count(oid)")}
                as TAXA_CANCELAMENTO_PCT
        from ord where order_month is not null group by order_month"""


def order_hours() -> str:
    return f"""
        select hour_of_day as HORA_DO_DIA, weekday as DIA_DA_SEMANA,
            count(oid) as TOTAL_PEDIDOS,
            {r("avg(took) filter (status = 'delivered')", 1)} as MEDIA_DIAS_ENTREGA
        from ord where bought is not null group by hour_of_day, weekday"""


def delivery_times() -> str:
    return f"""
        select customer_state as STATE, {ORDERS} as TOTAL_ORDERS,
            {r("avg(took)", 1)} as AVG_DELIVERY_DAYS,
            {r("min(took)", 1)} as MIN_DELIVERY_DAYS,
            {r("max(took)", 1)} as MAX_DELIVERY_DAYS,
            {r("avg(datediff('day', bought, promised))", 1)} as AVG_ESTIMATED_DAYS
        from done join cust on customer_id = cid
        where arrived is not null and bought is not null group by customer_state"""


def late_deliveries(names: bool) -> str:
    return f"""
        select {YEAR} as YEAR, {MONTH} as MONTH,
            {MONTH_NAME + " as MONTH_NAME," if names else ""}
            {ORDERS} as TOTAL_ORDERS, {LATE} as LATE_ORDERS,
            count(distinct oid) filter (not late) as ON_TIME_ORDERS,
            {pct(LATE, ORDERS)} as LATE_RATE_PCT, {r("avg(overdue)", 1)} as AVG_DAYS_LATE
        from arrivals group by all"""


def delay_by_state() -> str:
    return f"""
        select customer_state as STATE, {ORDERS} as TOTAL_ORDERS, {LATE} as LATE_ORDERS,
            {pct(LATE, ORDERS)} as LATE_RATE_PCT,
            {r("avg(overdue) filter (late)", 1)} as AVG_DAYS_LATE
        from arrivals join cust on customer_id = cid group by customer_state"""


def delay_by_category(limit: int | None) -> str:
    return f"""
        select CATEGORY, {ORDERS} as TOTAL_ORDERS, {LATE} as LATE_ORDERS,
            {pct(LATE, ORDERS)} as LATE_RATE_PCT, {r("avg(took)", 1)} as AVG_DELIVERY_DAYS
        from arrivals join goods using (oid) group by CATEGORY having {ORDERS} >= 100
        {top("LATE_RATE_PCT desc, CATEGORY", limit)}"""


def delay_scores() -> str:
    return f"""
        select case when overdue <= -7 then 'very early (7+ days before)'
                    when overdue < 0 then 'early (1-6 days before)'
                    when overdue = 0 then 'on time'
                    when overdue <= 7 then 'late (1-7 days)'
                    else 'very late (7+ days)' end as DELIVERY_STATUS,
            {ORDERS} as TOTAL_ORDERS, {r("avg(review_score)")} as AVG_REVIEW_SCORE,
            {r("min(review_score)")} as MIN_SCORE, {r("max(review_score)")} as MAX_SCORE
        from arrivals join rev on rev.order_id = oid group by DELIVERY_STATUS"""


def top_sellers() -> str:
    return f"""
        select seller_id as SELLER_ID, seller_city as CITY, seller_state as STATE,
            {ORDERS} as TOTAL_ORDERS, count(distinct product_id) as UNIQUE_PRODUCTS,
            {r("sum(price)")} as TOTAL_REVENUE, {r("avg(price)")} as AVG_ITEM_PRICE,
            {pct("sum(price)", "sum(sum(price)) over ()")} as REVENUE_SHARE_PCT
        from {SHOP.format(orders="done")} group by seller_id, seller_city, seller_state
        order by TOTAL_REVENUE desc, SELLER_ID limit 20"""


def late_sellers() -> str:
    return f"""
        select seller_id as SELLER_ID, seller_city as CITY, seller_state as STATE,
            {ORDERS} as TOTAL_ORDERS, {LATE} as LATE_ORDERS,
            {pct(LATE, ORDERS)} as LATE_RATE_PCT,
            {r("avg(overdue) filter (late)", 1)} as AVG_DAYS_LATE
        from {SHOP.format(orders="arrivals")}
        group by seller_id, seller_city, seller_state having {ORDERS} >= 30
        order by LATE_RATE_PCT desc, SELLER_ID limit 20"""


GOOD = "count(distinct oid) filter (review_score >= 4)"
BAD = "count(distinct oid) filter (review_score <= 2)"
FIVE = "count(distinct oid) filter (review_score = 5)"
ONE = "count(distinct oid) filter (review_score = 1)"


def best_sellers() -> str:
    return f"""
        select seller_id as SELLER_ID, seller_city as CITY, seller_state as STATE,
            {ORDERS} as TOTAL_ORDERS, {r("avg(review_score)")} as AVG_REVIEW_SCORE,
            {FIVE} as FIVE_STAR_ORDERS, {ONE} as ONE_STAR_ORDERS,
            {pct(GOOD, ORDERS)} as POSITIVE_RATE_PCT
        from {SHOP.format(orders="done")} join rev on rev.order_id = oid
        group by seller_id, seller_city, seller_state having {ORDERS} >= 30
        order by AVG_REVIEW_SCORE desc, SELLER_ID limit 20"""


def sellers_by_state() -> str:
    return f"""
        select seller_state as STATE, count(distinct seller_id) as ACTIVE_SELLERS,
            {ORDERS} as TOTAL_ORDERS, {r("sum(price)")} as TOTAL_REVENUE,
            {r("avg(price)")} as AVG_ITEM_PRICE,
            {r(f"cast({ORDERS} as double) / nullif(count(distinct seller_id), 0)", 1)}
                as ORDERS_PER_SELLER
        from {SHOP.format(orders="done")} group by seller_state"""


def score_distribution() -> str:
    reviews = "count(distinct review_id)"
    return f"""
        select review_score as SCORE, {reviews} as TOTAL_REVIEWS,
            {pct(reviews, f"sum({reviews}) over ()")} as SHARE_PCT,
            {r("avg(took)", 1)} as AVG_DELIVERY_DAYS
        from rev join done on oid = order_id group by review_score"""


def category_reviews(worst: int | None) -> str:
    stars = f"{ONE} as ONE_STAR, {FIVE} as FIVE_STAR" if worst else f"{FIVE} as FIVE_STAR, {ONE} as ONE_STAR"
    good = "" if worst else f", {pct(GOOD, ORDERS)} as POSITIVE_RATE_PCT"
    return f"""
        select CATEGORY, {ORDERS} as TOTAL_ORDERS, {r("avg(review_score)")} as AVG_SCORE,
            {stars},
            {pct(BAD, ORDERS)} as NEGATIVE_RATE_PCT {good}
        from {SOLD} join rev on rev.order_id = oid
        group by CATEGORY having {ORDERS} >= 100
        {top("AVG_SCORE, CATEGORY", worst)}"""


def duration_scores() -> str:
    return f"""
        select case when took <= 3 then '1-3 days' when took <= 7 then '4-7 days'
                    when took <= 14 then '8-14 days' when took <= 21 then '15-21 days'
                    else '22+ days' end as DELIVERY_RANGE,
            {ORDERS} as TOTAL_ORDERS, {r("avg(review_score)")} as AVG_SCORE,
            {pct(GOOD, ORDERS)} as POSITIVE_RATE_PCT
        from done join rev on rev.order_id = oid
        where arrived is not null and bought is not null group by DELIVERY_RANGE"""


def response_scores() -> str:
    good = "count(distinct review_id) filter (review_score >= 4)"
    return f"""
        select case when waited = 0 then 'same day' when waited <= 3 then '1-3 days'
                    when waited <= 7 then '4-7 days' else '7+ days' end as RESPONSE_TIME,
            count(distinct review_id) as TOTAL_REVIEWS,
            {r("avg(review_score)")} as AVG_SCORE,
            {pct(good, "count(distinct review_id)")} as POSITIVE_RATE_PCT
        from (select *, datediff('day', cast(review_creation_date as timestamp),
                  cast(review_answer_timestamp as timestamp)) as waited
              from rev where review_creation_date is not null
                  and review_answer_timestamp is not null)
            join done on oid = order_id
        group by RESPONSE_TIME"""


def peak_hours() -> str:
    whole = f"sum({ORDERS}) over (partition by dayofweek(bought))"
    return f"""
        select cast(dayofweek(bought) as integer) as DAY_NUMBER,
            strftime(bought, '%a') as DAY_NAME,
            cast(hour(bought) as integer) as HOUR_OF_DAY, {ORDERS} as TOTAL_ORDERS,
            {pct(ORDERS, whole)} as HOUR_SHARE_PCT
        from done group by dayofweek(bought), DAY_NAME, hour(bought)"""


def monthly_best_category() -> str:
    return f"""
        select YEAR, MONTH, MONTH_NAME, CATEGORY as TOP_CATEGORY, TOTAL_ORDERS,
            TOTAL_REVENUE
        from (select {YEAR} as YEAR, {MONTH} as MONTH, {MONTH_NAME} as MONTH_NAME,
                  CATEGORY, {ORDERS} as TOTAL_ORDERS, {r("sum(price)")} as TOTAL_REVENUE
              from {SOLD} group by all)
        qualify row_number() over (partition by YEAR, MONTH
            order by TOTAL_REVENUE desc, CATEGORY) = 1"""


def commercial_days(limit: int | None) -> str:
    return f"""
        select ORDER_DATE, TOTAL_ORDERS, TOTAL_REVENUE,
            -- Fixed values: label by month and day.
            case when strftime(ORDER_DATE, '%m-%d') in ('11-24') then 'Black Friday 2017'
                when strftime(ORDER_DATE, '%m-%d') in ('11-23') then 'Black Friday 2018'
                when strftime(ORDER_DATE, '%m-%d') in ('12-24', '12-25') then 'Christmas'
                when strftime(ORDER_DATE, '%m-%d') in ('01-01', '01-02') then 'New Year'
                when strftime(ORDER_DATE, '%m-%d') in ('02-12', '02-13', '02-14') then 'Valentines'
                when strftime(ORDER_DATE, '%m-%d') in ('05-13', '05-14') then 'Mothers Day'
                else 'regular day' end as DATE_TYPE
        from (select cast(date_trunc('day', bought) as timestamp) as ORDER_DATE,
                  {ORDERS} as TOTAL_ORDERS, {r("sum(payment_value)")} as TOTAL_REVENUE
              from {PAID} group by all)
        {top("TOTAL_ORDERS desc, ORDER_DATE", limit)}"""


# --- fraud ---------------------------------------------------------------------

SHARED = """
    select credit_card_token as CREDIT_CARD_TOKEN,
        count(distinct customer_id) as CUSTOMERS_SHARING_CARD,
        count(distinct full_name) as DIFFERENT_NAMES,
        count(distinct customer_state) as DIFFERENT_STATES,
        count(distinct customer_city) as DIFFERENT_CITIES,
        string_agg(distinct full_name, ' | ' order by full_name) as NAMES_LIST
    from cext where credit_card_token is not null
    group by credit_card_token having count(distinct customer_id) > 1"""

RISK = """case when CUSTOMERS_SHARING_CARD >= 10 then 'critical'
               when CUSTOMERS_SHARING_CARD >= 5 then 'high'
               when CUSTOMERS_SHARING_CARD >= 2 then 'medium' else 'low' end"""

NEGATIVE = """
    select order_id as ORDER_ID, payment_value as PAYMENT_VALUE,
        payment_type as PAYMENT_TYPE, 'negative_payment_value' as FRAUD_TYPE,
        'high' as RISK_LEVEL
    from pay where payment_value < 0"""

EARLY = """
    select ORDER_ID, ORDER_PURCHASED_AT, ORDER_DELIVERED_AT,
        'delivery_before_purchase' as FRAUD_TYPE, 'high' as RISK_LEVEL
    from stg where ORDER_DELIVERED_AT < ORDER_PURCHASED_AT"""

FLAGGED = f"""
    select customer_id as CUSTOMER_ID, full_name as FULL_NAME, email as EMAIL,
        cext.credit_card_token as CREDIT_CARD_TOKEN,
        credit_card_last4 as CREDIT_CARD_LAST4, customer_state as CUSTOMER_STATE,
        customer_city as CUSTOMER_CITY, is_synthetic as IS_SYNTHETIC,
        data_source as DATA_SOURCE, CUSTOMERS_SHARING_CARD, DIFFERENT_NAMES,
        DIFFERENT_STATES, NAMES_LIST, {RISK} as RISK_LEVEL,
        'shared_credit_card' as FRAUD_TYPE
    from cext join ({SHARED}) as shared
        on shared.CREDIT_CARD_TOKEN = cext.credit_card_token"""

SIGNALS = f"""
    select CUSTOMER_ID, FULL_NAME, EMAIL, CREDIT_CARD_TOKEN, CREDIT_CARD_LAST4,
        CUSTOMER_STATE, CUSTOMER_CITY, FRAUD_TYPE, RISK_LEVEL, CUSTOMERS_SHARING_CARD,
        DIFFERENT_NAMES, NAMES_LIST, IS_SYNTHETIC, DATA_SOURCE,
        timestamp '{DETECTED_AT}' as DETECTED_AT
    from ({FLAGGED})"""

ALL_SIGNALS = f"""
    select CUSTOMER_ID as SUBJECT_ID, FRAUD_TYPE, RISK_LEVEL from ({FLAGGED})
    union all select ORDER_ID, FRAUD_TYPE, RISK_LEVEL from ({NEGATIVE})
    union all select ORDER_ID, FRAUD_TYPE, RISK_LEVEL from ({EARLY})"""


MODEL_SQL: dict[str, str] = {
    "stg_orders": "select * from stg",
    "mart_sazonalidade": monthly_orders(),
    "mart_clientes_top": customers_by_spend(),
    "mart_horarios_pico": order_hours(),
    "mart_perfil_cliente": profile_by_city(),
    "mart_top_categories": top_categories(),
    "mart_revenue_trend": revenue_trend(names=True),
    "mart_ticket_by_category": ticket(None),
    "mart_customer_profile_by_state": profile_by_state(),
    "mart_delivery_time_by_state": delivery_times(),
    "mart_late_deliveries": late_deliveries(names=True),
    "mart_delay_by_category": delay_by_category(None),
    "mart_top_sellers": top_sellers(),
    "mart_reviews_by_category": category_reviews(None),
    "mart_seasonality": seasonality(dates=True),
    "mart_peak_hours": peak_hours(),
    "mart_top_category_by_month": monthly_best_category(),
    "mart_seasonal_dates": commercial_days(None),
    "mart_fraud_signals": SIGNALS,
    "a01_top_categories_by_revenue": top_categories(),
    "a02_monthly_revenue_trend": revenue_trend(names=False),
    "a03_cancellation_rate_by_category": cancellations(),
    "a04_avg_ticket_by_category": ticket(15),
    "a05_pareto_revenue_by_category": pareto(),
    "a06_payment_method_by_state": payment_methods(),
    "a07_installments_by_category": installments(),
    "a08_single_purchase_customers": single_purchase(),
    "a09_customers_above_avg_ticket": above_mean(),
    "a10_top_customers_geographic_profile": geographic_profile(),
    "a11_lifetime_value_by_state": lifetime_values(),
    "a12_recurring_vs_unique_customers": recurring(),
    "a13_avg_delivery_time_by_state": delivery_times(),
    "a14_late_deliveries_vs_estimated": late_deliveries(names=False),
    "a15_delay_rate_by_state": delay_by_state(),
    "a16_delay_rate_by_category": delay_by_category(15),
    "a17_delay_vs_review_score": delay_scores(),
    "a18_top_sellers_by_revenue": top_sellers(),
    "a19_sellers_with_highest_delay": late_sellers(),
    "a20_sellers_best_reviews": best_sellers(),
    "a21_active_sellers_by_state": sellers_by_state(),
    "a22_review_score_distribution": score_distribution(),
    "a23_worst_reviewed_categories": category_reviews(15),
    "a24_delivery_time_vs_review": duration_scores(),
    "a25_seller_response_time_vs_review": response_scores(),
    "a26_annual_monthly_seasonality": seasonality(dates=False),
    "a27_peak_hours_by_weekday": peak_hours(),
    "a28_top_category_by_month": monthly_best_category(),
    "a29_black_friday_seasonal_dates": commercial_days(30),
    "fraud_shared_card": SHARED,
    "fraud_negative_payments": NEGATIVE,
    "fraud_invalid_dates": EARLY,
    "fraud_customers": FLAGGED,
    "fraud_signals_all": ALL_SIGNALS,
}
