"""The derivation of `sources.bridge` once more, as CTEs for an independent engine."""

from __future__ import annotations

# Common table expressions, in dependency order. Names avoid those of the inputs.
CTES: dict[str, str] = {
    "facts": """
        select *,
            case when order_status = 'delivered' and k % 101 <> 0 then
                case when k % 499 = 0 then purchased - to_days(1)
                     else purchased + to_days(cast(3 + (k * 13) % 43 as integer)) end
            end as delivered
        from (
            select o_orderkey as k,
                cast(o_orderkey as varchar) as order_id,
                cast(o_custkey as varchar) as customer_id,
                case when o_orderstatus = 'F' then 'delivered'
                     when o_orderstatus = 'O' and o_orderkey % 3 <> 0 then 'delivered'
                     when o_orderstatus = 'O' then 'shipped'
                     when o_orderstatus = 'P' and o_orderkey % 4 = 0 then 'canceled'
                     else 'processing' end as order_status,
                o_orderdate + to_minutes(cast((o_orderkey * 37) % 1440 as integer))
                    as purchased,
                cast(o_orderpriority[1] as integer) as priority,
                o_totalprice as total
            from orders)""",
    "raw_orders": """
        select order_id, customer_id, order_status,
            strftime(purchased, '%Y-%m-%d %H:%M:%S') as order_purchase_timestamp,
            strftime(purchased + to_hours(cast(1 + k % 48 as integer)),
                '%Y-%m-%d %H:%M:%S') as order_approved_at,
            strftime(purchased + to_days(cast(1 + k % 5 as integer)),
                '%Y-%m-%d %H:%M:%S') as order_delivered_carrier_date,
            strftime(delivered, '%Y-%m-%d %H:%M:%S') as order_delivered_customer_date,
            strftime(date_trunc('day', purchased)
                + to_days(cast(7 + (k * 7) % 24 as integer)), '%Y-%m-%d %H:%M:%S')
                as order_estimated_delivery_date
        from facts""",
    "stg": """
        select order_id as ORDER_ID, customer_id as CUSTOMER_ID,
            order_status as ORDER_STATUS, p as ORDER_PURCHASED_AT,
            cast(order_approved_at as timestamp) as ORDER_APPROVED_AT,
            cast(order_delivered_carrier_date as timestamp) as ORDER_SHIPPED_AT,
            cast(order_delivered_customer_date as timestamp) as ORDER_DELIVERED_AT,
            cast(order_estimated_delivery_date as timestamp) as ORDER_ESTIMATED_AT,
            cast(date_trunc('month', p) as timestamp) as ORDER_MONTH,
            cast(date_trunc('hour', p) as timestamp) as ORDER_HOUR,
            cast(dayofweek(p) as integer) as ORDER_DAY_OF_WEEK,
            cast(hour(p) as integer) as ORDER_HOUR_OF_DAY
        from (select *, cast(order_purchase_timestamp as timestamp) as p
              from raw_orders)""",
    "ord": """
        select ORDER_ID as oid, CUSTOMER_ID as cid, ORDER_STATUS as status,
            ORDER_PURCHASED_AT as bought, ORDER_DELIVERED_AT as arrived,
            ORDER_ESTIMATED_AT as promised, ORDER_MONTH as order_month,
            ORDER_DAY_OF_WEEK as weekday, ORDER_HOUR_OF_DAY as hour_of_day,
            ORDER_DELIVERED_AT > ORDER_ESTIMATED_AT as late,
            datediff('day', ORDER_PURCHASED_AT, ORDER_DELIVERED_AT) as took,
            datediff('day', ORDER_ESTIMATED_AT, ORDER_DELIVERED_AT) as overdue
        from stg""",
    "done": "select * from ord where status = 'delivered'",
    "arrivals": "select * from done where arrived is not null and promised is not null",
    "items": """
        select cast(l_orderkey as varchar) as order_id, l_linenumber as order_item_id,
            cast(l_partkey as varchar) as product_id,
            cast(l_suppkey as varchar) as seller_id,
            strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as shipping_limit_date,
            l_extendedprice as price, l_extendedprice * l_tax as freight_value
        from lineitem""",
    "pay": """
        select order_id, 1 as payment_sequential,
            case when priority <= 3 then 'credit_card' when priority = 4 then 'boleto'
                 when k % 2 = 0 then 'voucher' else 'debit_card' end as payment_type,
            case when priority <= 3 then cast(1 + k % 12 as integer) else 1 end
                as payment_installments,
            case when k % 997 = 0 then -total else total end as payment_value
        from facts
        union all
        select order_id, 2, 'voucher', 1, cast(k % 100 as double) + 0.25
        from facts where k % 5 = 0""",
    "rev": """
        select concat('r', order_id) as review_id, order_id,
            cast(case k % 10 when 0 then 1 when 1 then 2 when 2 then 3 when 3 then 4
                 when 4 then 4 when 5 then 4 else 5 end as integer) as review_score,
            cast(null as varchar) as review_comment_title,
            cast(null as varchar) as review_comment_message,
            strftime(delivered + to_days(cast(1 + k % 7 as integer)),
                '%Y-%m-%d %H:%M:%S') as review_creation_date,
            case when k % 23 <> 0 then
                strftime(delivered + to_days(cast(1 + k % 7 + k % 11 as integer)),
                    '%Y-%m-%d %H:%M:%S') end as review_answer_timestamp
        from facts where delivered is not null and k % 9 <> 0""",
    "prod": """
        select cast(p_partkey as varchar) as product_id,
            case when p_partkey % 17 <> 0
                 then lower(concat(p_type, '_', p_brand)) end as product_category_name
        from part""",
    "tran": """
        select distinct product_category_name,
            concat('en_', product_category_name) as product_category_name_english
        from prod
        where product_category_name is not null
            and length(product_category_name) % 2 = 0""",
    "labelled": """
        select product_id, coalesce(product_category_name_english,
            prod.product_category_name, 'unknown') as CATEGORY
        from prod left join tran
            on prod.product_category_name = tran.product_category_name""",
    "goods": """
        select items.order_id as oid, items.product_id, items.price, labelled.CATEGORY
        from items join labelled on labelled.product_id = items.product_id""",
    "people": """
        select c_custkey as ck, cast(c_custkey as varchar) as customer_id,
            c_name as full_name,
            chr(65 + c_nationkey // 5) || chr(65 + c_nationkey % 5) as customer_state,
            concat(n_name, case when c_custkey % 10 = 0 then '_rural'
                                else '_capital' end) as customer_city
        from customer join nation on c_nationkey = n_nationkey""",
    "cust": "select customer_id, customer_city, customer_state from people",
    "sell": """
        select cast(s_suppkey as varchar) as seller_id,
            concat('city_', cast(s_suppkey % 7 as varchar)) as seller_city,
            n_name as seller_state
        from supplier join nation on s_nationkey = n_nationkey""",
    "geo": """
        select lpad(cast(ck % 100000 as varchar), 5, '0') as geolocation_zip_code_prefix,
            customer_city as geolocation_city, customer_state as geolocation_state
        from people""",
    "cext": """
        select customer_id, full_name,
            concat('c', customer_id, '@example.com') as email,
            concat('+55', customer_id) as phone,
            lpad(cast(ck % 100000 as varchar), 11, '0') as document_number,
            case when ck < 20 then 'tok_a' when ck < 27 then 'tok_b'
                 when ck < 30 then 'tok_c' when ck % 50 = 49 then null
                 else concat('tok_', customer_id) end as credit_card_token,
            lpad(cast(ck % 10000 as varchar), 4, '0') as credit_card_last4,
            true as lgpd_accepted, t as lgpd_accepted_at,
            ck % 10 < 7 as marketing_opt_in,
            case when ck % 10 < 7 then t end as marketing_opt_in_at,
            customer_state, customer_city, t as created_at,
            ck % 2 = 0 as is_synthetic,
            case when ck < 30 then 'synthetic_fraud_2019'
                 else 'synthetic_2019' end as data_source
        from (select *, timestamp '2018-01-01' + to_minutes(cast(ck % 1000 as integer))
                  as t from people)""",
}


def with_bridge(body: str, extra: dict[str, str] | None = None, base: dict[str, str] = CTES) -> str:
    """A complete statement: the derivation, further CTEs, then the query."""
    parts = {**base, **(extra or {})}
    listed = ",\n".join(f"{name} as ({text})" for name, text in parts.items())
    return f"with {listed}\n{body}"
