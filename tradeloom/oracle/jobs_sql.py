"""Oracle SQL of the storage, quality and synthetic-data jobs."""

from __future__ import annotations

from tradeloom.oracle.bridge_sql import CTES
from tradeloom.oracle.models_sql import MODEL_SQL, MONTHLY, SOLD, pct, r
from tradeloom.schemas import MART_DDL, RAW_DDL, TEXT_LIMITS

# Raw table -> the CTE it corresponds to.
RAW_CTES = {
    "orders": "raw_orders",
    "order_items": "items",
    "order_payments": "pay",
    "order_reviews": "rev",
    "customers": "cust",
    "sellers": "sell",
    "products": "prod",
    "translation": "tran",
    "geolocation": "geo",
    "customers_extended": "cext",
}


def columns_of(ddl: str) -> list[tuple[str, str]]:
    return [tuple(part.split()) for part in ddl.split(",")]


def column_check(table: str, source: str, column: str, kind: str) -> str:
    text = {
        "string": column,
        "timestamp": f"strftime({column}, '%Y-%m-%d %H:%M:%S')",
        "timestamp_ntz": f"strftime({column}, '%Y-%m-%d %H:%M:%S')",
    }.get(kind)
    if text:
        number = f"cast('0x' || substr(md5({text}), 1, 8) as bigint)"
    elif kind == "boolean":
        number = f"cast({column} as bigint)"
    else:
        number = f"cast(round(cast({column} as double) * 10000) as bigint)"
    return f"""select '{table}' as TABLE_NAME, count(*) as ROW_COUNT, '{column}' as COLUMN_NAME,
                   count({column}) as VALUE_COUNT,
                   cast(sum({number}) % 1000000007 as bigint) as CHECKSUM
               from {source}"""


def table_checks(names, label: str = "") -> str:
    return " union all ".join(
        column_check(f"{label}{name}", RAW_CTES[name], column, kind)
        for name in names
        for column, kind in columns_of(RAW_DDL[name])
    )


# --- data quality ---------------------------------------------------------------


def nulls(source: str, column: str, head: str = "") -> str:
    return f"""select {head} 'not_null' as CHECK_NAME, '{column}' as COLUMN_NAME,
                   count(*) as FAILURES from {source} where {column} is null"""


def repeats(source: str, column: str, head: str = "") -> str:
    return f"""select {head} 'unique' as CHECK_NAME, '{column}' as COLUMN_NAME,
                   count(*) as FAILURES
               from (select {column} from {source} where {column} is not null
                     group by {column} having count(*) > 1)"""


def strangers(source: str, column: str, values: list, head: str = "") -> str:
    listed = ", ".join(repr(value) for value in values)
    return f"""select {head} 'accepted_values' as CHECK_NAME, '{column}' as COLUMN_NAME,
                   count(distinct {column}) as FAILURES
               from {source} where {column} not in ({listed})"""


MONTHS = list(range(1, 13))

# The declared checks: model -> (not null, unique, accepted values).
DECLARED = {
    "stg_orders": (
        ["ORDER_ID", "CUSTOMER_ID"],
        ["ORDER_ID"],
        {
            # Fixed values.
            "ORDER_STATUS": [
                "delivered", "shipped", "canceled", "unavailable",
                "invoiced", "processing", "created", "approved",
            ]
        },
    ),
    "mart_sazonalidade": (["MES"], ["MES"], {"NUMERO_MES": MONTHS}),
    "mart_clientes_top": (["CUSTOMER_ID"], ["CUSTOMER_ID"], {}),
    "mart_horarios_pico": (["HORA_DO_DIA", "DIA_DA_SEMANA"], [], {}),
    "mart_perfil_cliente": (["ESTADO", "CIDADE"], [], {}),
    "mart_top_categories": (["CATEGORY", "TOTAL_ORDERS"], ["CATEGORY"], {}),
    "mart_revenue_trend": (
        ["YEAR", "MONTH", "MONTH_DATE"],
        ["MONTH_DATE"],
        {"MONTH": MONTHS},
    ),
    "mart_ticket_by_category": (["CATEGORY"], ["CATEGORY"], {}),
    "mart_customer_profile_by_state": (["STATE"], ["STATE"], {}),
    "mart_delivery_time_by_state": (["STATE"], ["STATE"], {}),
    "mart_late_deliveries": (["YEAR", "MONTH"], [], {"MONTH": MONTHS}),
    "mart_delay_by_category": (["CATEGORY"], ["CATEGORY"], {}),
    "mart_top_sellers": (["SELLER_ID"], ["SELLER_ID"], {}),
    "mart_reviews_by_category": (["CATEGORY"], ["CATEGORY"], {}),
    "mart_seasonality": (
        ["YEAR", "MONTH", "MONTH_DATE"],
        ["MONTH_DATE"],
        {"MONTH": MONTHS},
    ),
    "mart_peak_hours": (["DAY_NUMBER", "HOUR_OF_DAY"], [], {}),
    "mart_top_category_by_month": (["YEAR", "MONTH"], [], {"MONTH": MONTHS}),
    "mart_seasonal_dates": (
        ["ORDER_DATE", "DATE_TYPE"],
        [],
        {
            "DATE_TYPE": [
                "Black Friday 2017",
                "Black Friday 2018",
                "Christmas",
                "New Year",
                "Valentines",
                "Mothers Day",
                "regular day",
            ]
        },
    ),
    "mart_fraud_signals": (
        ["CUSTOMER_ID", "FRAUD_TYPE", "RISK_LEVEL", "DETECTED_AT"],
        [],
        {
            "FRAUD_TYPE": [
                "shared_credit_card",
                "negative_payment_value",
                "delivery_before_purchase",
            ],
            "RISK_LEVEL": ["critical", "high", "medium", "low"],
        },
    ),
}


def suite() -> str:
    parts = []
    for model, (required, single, accepted) in DECLARED.items():
        head = f"'{model}' as MODEL,"
        parts += [nulls(model, column, head) for column in required]
        parts += [repeats(model, column, head) for column in single]
        parts += [strangers(model, c, values, head) for c, values in accepted.items()]
    return " union all ".join(parts)


# --- synthetic data -------------------------------------------------------------


def draw(key: str, label: str, size: int) -> str:
    return f"(cast('0x' || substr(md5({key} || '/{label}'), 1, 12) as bigint) % {size})"


def pick(options: list[str], key: str, label: str) -> str:
    listed = ", ".join(f"'{option}'" for option in options)
    return f"list_extract([{listed}], {draw(key, label, len(options))} + 1)"


def pick_weighted(weights: dict[str, int], key: str, label: str) -> str:
    drawn, bound, steps = draw(key, label, sum(weights.values())), 0, []
    for value, weight in weights.items():
        bound += weight
        steps.append(f"when {drawn} < {bound} then '{value}'")
    return f"case {' '.join(steps)} end"


def padded(text: str, width: int) -> str:
    return f"lpad({text}, cast(greatest({width}, length({text})) as integer), '0')"


def four(key: str, label: str) -> str:
    return f"cast({draw(key, label, 9000)} + 1000 as varchar)"


def money(key: str, label: str, low: int, high: int) -> str:
    return f"cast({draw(key, label, high - low + 1)} + {low} as double) / cast(100 as double)"


def later(moment: str, unit: str, amount: str) -> str:
    return f"({moment} + to_{unit}(cast({amount} as integer)))"


def past(key: str, label: str, years: int) -> str:
    seconds = draw(key, label, years * 365 * 86400)
    return f"(timestamp '2026-01-01 00:00:00' - to_seconds({seconds}))"


def text(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S')"


def check_digit(number: str, digits: int) -> str:
    total = " + ".join(
        f"cast(substr({number}, {i}, 1) as integer) * {digits + 2 - i}"
        for i in range(1, digits + 1)
    )
    return f"cast(case when ({total}) % 11 < 2 then 0 else 11 - ({total}) % 11 end as varchar)"


def cpf(nine: str) -> str:
    ten = f"({nine} || {check_digit(nine, 9)})"
    return f"{ten} || {check_digit(ten, 10)}"


# Domains, and values with their weights.
STATES = [
    "SP", "RJ", "MG", "RS", "PR", "SC", "BA", "GO", "PE", "CE", "PA", "MA", "MS", "MT",
    "RN", "AL", "PB", "SE", "PI", "TO", "RO", "AM", "AC", "AP", "RR", "DF", "ES",
]
STATUSES = {"delivered": 5, "shipped": 1, "canceled": 1, "invoiced": 1, "processing": 1}
PAYMENTS = {"credit_card": 3, "boleto": 1, "voucher": 1, "debit_card": 1}
CLUSTER = "'fraud:cluster'"


def _keyed(kind: str, table: str, column: str) -> str:
    key = f"'{kind}:' || cast({column} as varchar)"
    nine = padded(f"cast({draw('(' + key + ')', 'cpf', 10**9)} as varchar)", 9)
    return f"""(select cast({column} as varchar) as number, {key} as key, {nine} as nine
                from {table})"""


def _shared_columns(kind: str, years: int) -> str:
    return f"""
        '{kind}_' || {padded("number", 6)} || '_' || substr(md5(key), 1, 8)
            as customer_id,
        '{kind} person ' || number as full_name,
        '{kind}.' || number || '@example.com' as email,
        '+55' || {padded(f"cast({draw('key', 'phone', 10**11)} as varchar)", 11)} as phone,
        {cpf("nine")} as document_number,
        {past("key", "consent", years)} as lgpd_accepted_at,
        {past("key", "created", years)} as created_at, true as is_synthetic"""


NORMAL = f"""
    select {_shared_columns("synthetic", 3)},
        substr(sha256(number || {four("key", "salt")}), 1, 32) as credit_card_token,
        {four("key", "last4")} as credit_card_last4, true as lgpd_accepted,
        {draw("key", "marketing", 10)} < 7 as marketing_opt_in,
        case when {draw("key", "marketing", 10)} < 7
             then {past("key", "consent", 3)} end as marketing_opt_in_at,
        {pick(STATES, "key", "state")} as customer_state,
        'city ' || cast({draw("key", "city", 500)} as varchar) as customer_city,
        'synthetic_2019' as data_source
    from {_keyed("synthetic", "customer", "c_custkey")}"""

FRAUDULENT = f"""
    select {_shared_columns("fraud", 2)},
        substr(sha256('99999' || {four(CLUSTER, "salt")}), 1, 32) as credit_card_token,
        {four(CLUSTER, "last4")} as credit_card_last4,
        {draw("key", "accepted", 10)} < 8 as lgpd_accepted,
        {draw("key", "marketing", 10)} < 5 as marketing_opt_in,
        {past("key", "consent", 2)} as marketing_opt_in_at,
        {pick(STATES, CLUSTER, "state")} as customer_state,
        'city ' || cast({draw(CLUSTER, "city", 500)} as varchar) as customer_city,
        'synthetic_fraud_2019' as data_source
    from {_keyed("fraud", "supplier", "s_suppkey")}"""

_EXTENDED = """customer_id, full_name, email, phone, document_number, credit_card_token,
    credit_card_last4, lgpd_accepted, lgpd_accepted_at, marketing_opt_in,
    marketing_opt_in_at, customer_state, customer_city, created_at, is_synthetic,
    data_source"""

_BOUGHT = later("timestamp '2019-01-01 00:00:00'", "seconds", draw("order_id", "purchase", 364 * 86400))

SYNTH_CTES = {
    "syn_people": f"select customer_id from ({NORMAL}) union all select customer_id from ({FRAUDULENT})",
    "syn_numbered": f"""
        select customer_id, md5(customer_id || '#' || cast(no as varchar)) as order_id
        from (select customer_id,
                  unnest(range(1, {draw("customer_id", "orders", 3)} + 2)) as no
              from syn_people)""",
    "syn_orders": f"""
        select *, case when order_status = 'delivered' then
                {later("bought", "days", draw("order_id", "delivery", 43) + " + 3")} end
                as arrived
        from (select *, {_BOUGHT} as bought,
                  {pick_weighted(STATUSES, "order_id", "status")} as order_status
              from syn_numbered)""",
    "syn_items": f"""
        select order_id, cast(no as integer) as order_item_id,
            md5(part || '/product') as product_id, md5(part || '/seller') as seller_id,
            {text(later("bought", "days", "3"))} as shipping_limit_date,
            {money("part", "price", 2000, 50000)} as price,
            {money("part", "freight", 500, 5000)} as freight_value
        from (select *, order_id || '#' || cast(no as varchar) as part
              from (select order_id, bought,
                        unnest(range(1, {draw("order_id", "items", 3)} + 2)) as no
                    from syn_orders))""",
}

_LUCK = draw("order_id", "score", 100)

# Exact sums over all rows and up to a row, by revenue.
EXACT = "cast(TOTAL_REVENUE as decimal(28, 2))"
WHOLE = f"sum({EXACT}) over ()"
RUNNING = f"""sum({EXACT}) over (order by TOTAL_REVENUE desc, {{key}}
    rows between unbounded preceding and current row)"""

JOB_SQL: dict[str, str] = {
    "src_csv_dir": table_checks([n for n in RAW_CTES if n != "customers_extended"]),
    "sink_replace": "select * from pay",
    "sink_append": "select * from pay",
    "src_table_filter": "select customer_id from cext where is_synthetic",
    "sink_create_if_absent": """
        select * replace (true as is_synthetic, 'synthetic_2019' as data_source) from cext""",
    "raw_sync": table_checks(RAW_CTES),
    "raw_sync_bucketed": table_checks(RAW_CTES),
    "raw_sync_changes": """
        select order_id, payment_sequential, payment_type, payment_installments, payment_value,
            case when order_id not in (select order_id from old) then 'inserted'
                 when order_id not in (select order_id from new) then 'deleted' else 'changed' end as CHANGE,
            coalesce(o.n, 0) as BEFORE, coalesce(p.n, 0) as AFTER
        from old o full join new p
            using (order_id, payment_sequential, payment_type, payment_installments, payment_value)
        where o.n is distinct from p.n""",
    "sink_upsert": """
        select * replace (
            customer_city || case when cast(customer_id as bigint) % 10 = 3 then '_new' else '' end as customer_city)
        from cext""",
    "src_registry": table_checks(RAW_CTES, "raw_"),
    "mat_view": """
        select ORDER_STATUS, count(*) as ORDERS, min(ORDER_PURCHASED_AT) as FIRST_AT,
            max(ORDER_PURCHASED_AT) as LAST_AT
        from stg group by ORDER_STATUS""",
    "mat_table": MODEL_SQL["mart_top_sellers"],
    "pipeline_run": " union all ".join(
        column_check(model, model, column, kind)
        for model in DECLARED
        if model != "stg_orders"
        for column, kind in columns_of(MART_DDL[model])
    ),
    "daily_refresh": " union all ".join(
        f"select '{model}' as MODEL, count(*) as ROW_COUNT from {model}"
        for model in DECLARED
        if model != "stg_orders"
    ),
    "dq_not_null": " union all ".join(
        nulls("stg", column)
        for column in (
            "ORDER_ID", "CUSTOMER_ID", "ORDER_STATUS", "ORDER_PURCHASED_AT",
            "ORDER_APPROVED_AT", "ORDER_SHIPPED_AT", "ORDER_DELIVERED_AT",
            "ORDER_ESTIMATED_AT", "ORDER_MONTH", "ORDER_HOUR", "ORDER_DAY_OF_WEEK",
            "ORDER_HOUR_OF_DAY",
        )
    ),
    "dq_unique": " union all ".join(
        repeats(RAW_CTES[name], "order_id", f"'{name}' as MODEL,")
        for name in ("orders", "order_items", "order_payments")
    ),
    "dq_accepted_values": " union all ".join(
        [
            strangers("stg", "ORDER_STATUS", ["delivered", "canceled"]),
            strangers("pay", "payment_type", ["credit_card"]),
            strangers("rev", "review_score", [1, 2, 3, 4, 5]),
        ]
    ),
    "quarantine_split": """
        select 'orders' as TABLE_NAME, order_id as KEY,
            cast(order_id as bigint) % 50 = 0 as REJECTED from raw_orders
        union all
        select 'order_reviews', review_id, cast(order_id as bigint) % 40 = 0 from rev""",
    "quarantine_readmission": """
        select order_id, order_status || case when no % 630 = 0 then '?' else '' end as order_status,
            case when no % 90 = 0 then 'yesterday' else order_purchase_timestamp end as order_purchase_timestamp,
            case when no % 90 = 0 then 'open'
                when (no % 50 = 0 and order_purchase_timestamp is not null)
                    or (no % 70 = 0 and order_status is not null) then 'back'
                else 'good' end as STATE,
            case when no % 90 = 0 then 'unreadable order_purchase_timestamp' else '' end
                || case when no % 630 = 0 then ', unaccepted order_status' else '' end as REASONS
        from (select *, cast(order_id as bigint) as no from raw_orders)""",
    "exact_revenue": """
        select payment_type as PAYMENT_METHOD, cast(grouping(payment_type) as int) as IS_TOTAL,
            count(payment_value) as PAYMENTS,
            cast(round(sum(cast(payment_value as decimal(28, 6))) * 100, 0) as bigint) as TOTAL_CENTS
        from pay group by rollup (payment_type)""",
    "event_driven_load": "select * from stg",
    "event_driven_repeats": "select * from stg",
    "event_driven_revenue": MODEL_SQL["mart_seasonal_dates"],
    "incremental_top_sellers": MODEL_SQL["mart_top_sellers"],
    "incremental_top_categories": MODEL_SQL["mart_top_categories"],
    "event_driven_days": """
        select cast(date_trunc('day', ORDER_PURCHASED_AT) as timestamp) as ORDER_DATE,
            count(ORDER_ID) as TOTAL_ORDERS,
            count(ORDER_ID) filter (ORDER_STATUS = 'delivered') as DELIVERED_ORDERS
        from stg group by 1""",
    "incremental_month": f"""
        select YEAR, MONTH, MONTH_NAME, MONTH_DATE, TOTAL_ORDERS,
            {r("s")} as TOTAL_REVENUE, {r("a")} as AVG_ORDER_VALUE from ({MONTHLY})""",
    "scd2_customers": """
        select customer_id, customer_city, customer_state, t1 as VALID_FROM,
            case when no % 10 = 3 or no % 17 = 0 then t2 end as VALID_TO,
            not (no % 10 = 3 or no % 17 = 0) as IS_CURRENT
        from numbered where no % 13 <> 0
        union all
        select customer_id, customer_city || case when no % 10 = 3 then '_new' else '' end,
            customer_state, t2, null, true
        from numbered where no % 17 <> 0 and (no % 13 = 0 or no % 10 = 3)""",
    "scd2_orders": """
        select ORDER_ID, o.CUSTOMER_ID, ORDER_PURCHASED_AT, case when here then city end as CITY,
            case when here then state end as STATE, case when here then since end as VALID_FROM
        from stg o asof left join begun b on o.CUSTOMER_ID = b.customer_id and o.ORDER_PURCHASED_AT >= b.t""",
    "pareto_products": f"""
        select *, {pct("TOTAL_REVENUE", WHOLE)} as REVENUE_SHARE_PCT,
            {pct(RUNNING.format(key="PRODUCT_ID"), WHOLE)} as CUMULATIVE_SHARE_PCT
        from (select product_id as PRODUCT_ID, {r("sum(price)")} as TOTAL_REVENUE from {SOLD} group by 1)""",
    "pareto_customers": f"""
        select CUSTOMER_ID, TOTAL_REVENUE,
            {r("lag(TOTAL_REVENUE) over (order by TOTAL_REVENUE desc, CUSTOMER_ID) - TOTAL_REVENUE")} as GAP_TO_BETTER,
            {pct("TOTAL_REVENUE", WHOLE)} as REVENUE_SHARE_PCT,
            {pct(RUNNING.format(key="CUSTOMER_ID"), WHOLE)} as CUMULATIVE_SHARE_PCT
        from (select cid as CUSTOMER_ID, {r("sum(payment_value)")} as TOTAL_REVENUE
              from done join pay on order_id = oid group by 1)""",
    "dq_text_limits": " union all ".join(
        f"""select 'text_limit' as CHECK_NAME, '{column}' as COLUMN_NAME,
                count(*) filter (length({column}) > {most}) as FAILURES from cext"""
        for column, limit in TEXT_LIMITS.items()
        for most in (limit, limit * 3 // 4)
    ),
    "dq_contract": """
        select ORDER_STATUS, count(ORDER_ID) as ORDERS,
            count(ORDER_DELIVERED_AT) as ARRIVALS
        from stg group by ORDER_STATUS""",
    "dq_suite": suite(),
    "synth_normal_customers": f"select {_EXTENDED} from ({NORMAL})",
    "synth_fraud_customers": f"select {_EXTENDED} from ({FRAUDULENT})",
    "synth_orders": f"""
        select order_id, customer_id, order_status,
            {text("bought")} as order_purchase_timestamp,
            {text(later("bought", "hours", draw("order_id", "approval", 48) + " + 1"))}
                as order_approved_at,
            {text(later("bought", "days", draw("order_id", "carrier", 5) + " + 1"))}
                as order_delivered_carrier_date,
            {text("arrived")} as order_delivered_customer_date,
            {text(later("bought", "days", draw("order_id", "estimate", 24) + " + 7"))}
                as order_estimated_delivery_date
        from syn_orders""",
    "synth_items": "select * from syn_items",
    "synth_payments": f"""
        select order_id, 1 as payment_sequential, payment_type,
            case when payment_type = 'credit_card' then
                cast({draw("order_id", "installments", 12)} + 1 as integer) else 1 end
                as payment_installments,
            payment_value
        from (select order_id, {pick_weighted(PAYMENTS, "order_id", "payment")} as payment_type,
                  cast(round(cast(sum(price) as decimal(28, 8)), 2) as double)
                      as payment_value
              from syn_items group by order_id)""",
    "synth_reviews": f"""
        select md5(order_id || '/review') as review_id, order_id,
            case when {_LUCK} < 5 then 1 when {_LUCK} < 10 then 2 when {_LUCK} < 20 then 3
                 when {_LUCK} < 50 then 4 else 5 end as review_score,
            cast(null as varchar) as review_comment_title,
            cast(null as varchar) as review_comment_message,
            {text(later("arrived", "days", draw("order_id", "created", 7) + " + 1"))}
                as review_creation_date,
            {text(later("arrived", "days", draw("order_id", "answered", 9) + " + 2"))}
                as review_answer_timestamp
        from syn_orders where arrived is not null""",
    "synth_card_token": """
        select customer_id,
            substr(sha256(customer_id || right(document_number, 4)), 1, 32) as card_token
        from cext""",
    "synth_cpf": f"""
        select customer_id, {cpf("nine")} as cpf,
            document_number = left(document_number, 9)
                || right({cpf("left(document_number, 9)")}, 2) as given_is_valid,
            true as built_is_valid
        from (select *, right(document_number, 9) as nine from cext)""",
}

# The raw tables after the synthetic load: what was given and what was generated.
GENERATED = {
    "raw_orders": ["synth_orders"],
    "items": ["synth_items"],
    "pay": ["synth_payments"],
    "rev": ["synth_reviews"],
    "cext": ["synth_normal_customers", "synth_fraud_customers"],
}
LOADED_CTES: dict[str, str] = {
    **SYNTH_CTES,
    **{
        name: " union all by name ".join(
            f"select * from ({part})" for part in [text, *(JOB_SQL[job] for job in GENERATED.get(name, []))]
        )
        for name, text in CTES.items()
    },
}
CHANGED_BY_LOAD = [
    "mart_sazonalidade",
    "mart_revenue_trend",
    "mart_seasonal_dates",
    "mart_peak_hours",
    "mart_fraud_signals",
]
JOB_SQL["synth_load"] = " union all ".join(
    column_check(model, model, column, kind)
    for model in CHANGED_BY_LOAD
    for column, kind in columns_of(MART_DDL[model])
)

# Further CTEs a statement needs besides the derivation of the inputs.
EXTRA_CTES: dict[str, dict[str, str]] = {
    **{name: SYNTH_CTES for name in ("synth_orders", "synth_items", "synth_payments", "synth_reviews")},
    **{name: {m: MODEL_SQL[m] for m in DECLARED} for name in ("dq_suite", "daily_refresh", "pipeline_run")},
    "scd2_customers": {
        "numbered": """
            select *, cast(customer_id as bigint) as no,
                timestamp '2025-01-01' as t1, timestamp '2026-01-01' as t2 from cust"""
    },
    "raw_sync_changes": {
        "was": "select *, cast(order_id as bigint) as no from pay",
        "old": "select * exclude (no), count(*) as n from was where no % 997 <> 0 group by all",
        "new": """
            select * exclude (no) replace (payment_value + case when no % 983 = 0 then 1 else 0 end as payment_value),
                count(*) as n
            from was where no % 991 <> 0 group by all""",
    },
    "scd2_orders": {
        "snaps": """
            select *, cast(customer_id as bigint) as no
            from cust, (values (1, timestamp '1993-06-01'), (2, timestamp '1995-06-01'), (3, timestamp '1997-06-01')) as v(snap, t)""",
        "seen": """
            select customer_id, snap, t, not (snap = 1 and no % 13 = 0 or snap = 2 and no % 17 = 0) as here,
                customer_city || case when snap = 2 and no % 10 = 3 then '_new' else '' end as city, customer_state as state
            from snaps""",
        "runs": """
            select *, case when here then city end is distinct from
                lag(case when here then city end) over (partition by customer_id order by snap) as opens
            from seen""",
        "begun": """
            select *, max(case when opens then t end) over (partition by customer_id order by snap) as since from runs""",
    },
    "synth_load": {m: MODEL_SQL[m] for m in CHANGED_BY_LOAD},
}
