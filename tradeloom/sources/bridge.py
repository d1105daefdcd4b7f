"""Derives the commerce tables from star-schema benchmark tables.

The derivation uses integer arithmetic only, so an independent SQL engine can
repeat it and the models can be checked against it. Every table is a row-wise
projection of one input (plus a lookup), so it grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeloom.operators.lookups import input_bytes
from tradeloom.session import fit_shuffles, tune
from tradeloom.sources.tables import Tables

# Columns read from the inputs. Declared, so that opening a table costs no job.
INPUT_DDL = {
    "orders": """
        o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """
        l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_extendedprice double, l_tax double, l_shipdate timestamp_ntz""",
    "part": "p_partkey bigint, p_brand string, p_type string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}


def _after(moment: str, unit: str, amount: str) -> str:
    return f"timestampadd({unit}, cast({amount} as int), {moment})"


def _text(moment: str) -> str:
    """Zone-less timestamp as `yyyy-MM-dd HH:mm:ss` text (whole seconds)."""
    return f"cast({moment} as string)"


class Bridge:
    """Lazily derived tables over the parquet files in one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(INPUT_DDL[name])
        return reader.parquet(f"{self.sf_dir}/{name}.parquet")

    def size(self) -> int:
        """Bytes of all input files."""
        return sum(input_bytes(self.read(name)) for name in INPUT_DDL)

    def order_facts(self) -> DataFrame:
        """Typed order moments, before they are presented as text."""
        days = "cast((k * 13) % 43 + 3 as int)"
        return (
            self.read("orders")
            .selectExpr(
                "o_orderkey as k",
                "cast(o_orderkey as string) as order_id",
                "cast(o_custkey as string) as customer_id",
                """case
                     when o_orderstatus = 'F'
                       or (o_orderstatus = 'O' and o_orderkey % 3 <> 0) then 'delivered'
                     when o_orderstatus = 'O' then 'shipped'
                     when o_orderstatus = 'P' and o_orderkey % 4 = 0 then 'canceled'
                     else 'processing' end as order_status""",
                _after("o_orderdate", "MINUTE", "(o_orderkey * 37) % 1440")
                + " as purchased",
                "cast(substr(o_orderpriority, 1, 1) as int) as priority",
                "o_totalprice as total",
            )
            .selectExpr(
                "*",
                f"""case when order_status = 'delivered' and k % 101 <> 0 then
                      timestampadd(DAY, if(k % 499 = 0, -1, {days}), purchased)
                    end as delivered""",
            )
        )

    def orders(self) -> DataFrame:
        midnight = "cast(cast(purchased as date) as timestamp_ntz)"
        return self.order_facts().selectExpr(
            "order_id",
            "customer_id",
            "order_status",
            _text("purchased") + " as order_purchase_timestamp",
            _text(_after("purchased", "HOUR", "k % 48 + 1")) + " as order_approved_at",
            _text(_after("purchased", "DAY", "k % 5 + 1"))
            + " as order_delivered_carrier_date",
            _text("delivered") + " as order_delivered_customer_date",
            _text(_after(midnight, "DAY", "(k * 7) % 24 + 7"))
            + " as order_estimated_delivery_date",
        )

    def order_items(self) -> DataFrame:
        return self.read("lineitem").selectExpr(
            "cast(l_orderkey as string) as order_id",
            "l_linenumber as order_item_id",
            "cast(l_partkey as string) as product_id",
            "cast(l_suppkey as string) as seller_id",
            _text("l_shipdate") + " as shipping_limit_date",
            "l_extendedprice as price",
            "l_extendedprice * l_tax as freight_value",
        )

    def order_payments(self) -> DataFrame:
        """One payment per order, and a second one for every fifth order."""
        first = """named_struct(
            'payment_sequential', 1,
            'payment_type', case when priority <= 3 then 'credit_card'
                                 when priority = 4 then 'boleto'
                                 when k % 2 = 0 then 'voucher' else 'debit_card' end,
            'payment_installments', if(priority <= 3, cast(k % 12 + 1 as int), 1),
            'payment_value', if(k % 997 = 0, -total, total))"""
        second = """named_struct(
            'payment_sequential', 2, 'payment_type', 'voucher',
            'payment_installments', 1,
            'payment_value', cast(k % 100 as double) + 0.25D)"""
        return self.order_facts().selectExpr(
            "order_id", f"inline(if(k % 5 = 0, array({first}, {second}), array({first})))"
        )

    def order_reviews(self) -> DataFrame:
        answered = _after("delivered", "DAY", "k % 7 + 1 + k % 11")
        facts = self.order_facts().where("delivered is not null and k % 9 <> 0")
        return facts.selectExpr(
            "concat('r', order_id) as review_id",
            "order_id",
            """case when k % 10 <= 2 then cast(k % 10 + 1 as int)
                    when k % 10 <= 5 then 4 else 5 end as review_score""",
            "cast(null as string) as review_comment_title",
            "cast(null as string) as review_comment_message",
            _text(_after("delivered", "DAY", "k % 7 + 1")) + " as review_creation_date",
            f"if(k % 23 <> 0, {_text(answered)}, null) as review_answer_timestamp",
        )

    def products(self) -> DataFrame:
        return self.read("part").selectExpr(
            "cast(p_partkey as string) as product_id",
            """if(p_partkey % 17 <> 0, lower(concat(p_type, '_', p_brand)), null)
               as product_category_name""",
        )

    def translation(self) -> DataFrame:
        """English names for the categories of even length; the others stay raw."""
        names = self.products().select("product_category_name").distinct()
        return names.where("length(product_category_name) % 2 = 0").selectExpr(
            "product_category_name",
            "concat('en_', product_category_name) as product_category_name_english",
        )

    def people(self) -> DataFrame:
        located = self.read("customer").join(
            self.read("nation").withColumnRenamed("n_nationkey", "c_nationkey"),
            "c_nationkey",
        )
        return located.selectExpr(
            "c_custkey as ck",
            "cast(c_custkey as string) as customer_id",
            "c_name as full_name",
            "concat(n_name, if(c_custkey % 10 = 0, '_rural', '_capital')) as customer_city",
            # A two-letter code of the nation key.
            """concat(char(65 + cast(c_nationkey / 5 as int)), char(65 + c_nationkey % 5))
               as customer_state""",
        )

    def customers(self) -> DataFrame:
        return self.people().select("customer_id", "customer_city", "customer_state")

    def customers_extended(self) -> DataFrame:
        accepted = _after("timestamp_ntz '2018-01-01 00:00:00'", "MINUTE", "ck % 1000")
        return self.people().selectExpr(
            "customer_id",
            "full_name",
            "concat('c', customer_id, '@example.com') as email",
            "concat('+55', customer_id) as phone",
            "lpad(cast(ck % 100000 as string), 11, '0') as document_number",
            """case when ck < 20 then 'tok_a' when ck < 27 then 'tok_b'
                    when ck < 30 then 'tok_c'
                    when ck % 50 <> 49 then concat('tok_', customer_id)
               end as credit_card_token""",
            "lpad(cast(ck % 10000 as string), 4, '0') as credit_card_last4",
            "true as lgpd_accepted",
            f"{accepted} as lgpd_accepted_at",
            "ck % 10 < 7 as marketing_opt_in",
            f"if(ck % 10 < 7, {accepted}, null) as marketing_opt_in_at",
            "customer_state",
            "customer_city",
            f"{accepted} as created_at",
            "ck % 2 = 0 as is_synthetic",
            "if(ck < 30, 'synthetic_fraud_2019', 'synthetic_2019') as data_source",
        )

    def sellers(self) -> DataFrame:
        located = self.read("supplier").join(
            self.read("nation").withColumnRenamed("n_nationkey", "s_nationkey"),
            "s_nationkey",
        )
        return located.selectExpr(
            "cast(s_suppkey as string) as seller_id",
            "concat('city_', cast(s_suppkey % 7 as string)) as seller_city",
            "n_name as seller_state",
        )

    def geolocation(self) -> DataFrame:
        return self.people().selectExpr(
            "lpad(cast(ck % 100000 as string), 5, '0') as geolocation_zip_code_prefix",
            "customer_city as geolocation_city",
            "customer_state as geolocation_state",
        )


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """All raw tables, derived lazily from the parquet files in `sf_dir`."""
    bridge = Bridge(tune(spark), sf_dir)
    fit_shuffles(spark, sf_dir, bridge.size)
    return Tables(
        {
            "orders": bridge.orders,
            "order_items": bridge.order_items,
            "order_payments": bridge.order_payments,
            "order_reviews": bridge.order_reviews,
            "customers": bridge.customers,
            "sellers": bridge.sellers,
            "products": bridge.products,
            "translation": bridge.translation,
            "geolocation": bridge.geolocation,
            "customers_extended": bridge.customers_extended,
        }
    )
