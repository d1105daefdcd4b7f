from pyspark.sql import functions as F
from shop import Shop, rows

from tradeloom.functions.identity import cpf_is_valid
from tradeloom.operators import quality
from tradeloom.plans import fraud, synthetic
from tradeloom.schemas import TEXT_LIMITS, raw_schema
from tradeloom.sources.tables import Tables


def people(spark, normal=900, fraudulent=100):
    return synthetic.normal_customers(spark.range(normal)).unionByName(
        synthetic.fraud_customers(spark.range(fraudulent))
    )


def test_fraud_cluster_is_found_exactly(spark):
    """The ground truth: every planted customer is critical, nobody else is flagged."""
    everyone = people(spark, normal=4500, fraudulent=500)
    t = Tables.of(**{**Shop(spark).tables().by_name(), "customers_extended": everyone})
    found = fraud.fraud_signals(t)
    summary = rows(
        found.groupBy("RISK_LEVEL", "DATA_SOURCE").agg(
            F.count_distinct("CUSTOMER_ID").alias("customers"),
            F.count_distinct("CREDIT_CARD_TOKEN").alias("tokens"),
        )
    )
    assert summary == [
        {
            "RISK_LEVEL": "critical",
            "DATA_SOURCE": "synthetic_fraud_2019",
            "customers": 500,
            "tokens": 1,
        }
    ]


def test_customer_columns(spark):
    df = people(spark)
    assert df.columns == raw_schema("customers_extended").names
    assert [f.dataType for f in df.schema] == [
        f.dataType for f in raw_schema("customers_extended")
    ]
    assert df.select("customer_id").distinct().count() == 1000
    assert df.where(~cpf_is_valid(F.col("document_number"))).count() == 0
    assert all(r["FAILURES"] == 0 for r in rows(quality.text_limits(df, TEXT_LIMITS)))
    normal = df.where("data_source = 'synthetic_2019'")
    opted = normal.where("marketing_opt_in").count() / 900
    assert 0.6 < opted < 0.8
    assert normal.where("not lgpd_accepted").count() == 0


def test_ids_wider_than_the_padding_stay_unique(spark):
    ids = spark.range(10**6, 10**6 + 50).union(spark.range(10**7, 10**7 + 50))
    assert synthetic.normal_customers(ids).select("customer_id").distinct().count() == 100


def test_orders_items_payments_reviews_belong_together(spark):
    facts = synthetic.order_facts(people(spark, 300, 30)).cache()
    orders, items = synthetic.orders(facts), synthetic.order_items(facts)
    payments, reviews = synthetic.order_payments(facts), synthetic.order_reviews(facts)
    for name, df in {
        "orders": orders,
        "order_items": items,
        "order_payments": payments,
        "order_reviews": reviews,
    }.items():
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in raw_schema(name)
        ]
    per_customer = orders.groupBy("customer_id").count()
    assert {r["count"] for r in per_customer.collect()} == {1, 2, 3}
    assert orders.where("year(cast(order_purchase_timestamp as timestamp_ntz)) <> 2019").count() == 0
    delivered = orders.where("order_status = 'delivered'").count()
    assert reviews.count() == delivered and 0.45 < delivered / orders.count() < 0.66
    assert orders.where(
        "(order_status = 'delivered') <> (order_delivered_customer_date is not null)"
    ).count() == 0
    sums = items.groupBy("order_id").agg(F.round(F.sum("price"), 2).alias("total"))
    off = payments.join(sums, "order_id", "full").where(
        "payment_value is null or total is null or abs(payment_value - total) > 0.001"
    )
    assert off.count() == 0
    assert items.where("price not between 20 and 500 or freight_value not between 5 and 50").count() == 0


def test_reruns_and_partitions_do_not_change_rows(spark):
    once = synthetic.orders(synthetic.order_facts(people(spark, 100, 10)))
    ids = spark.range(100).repartition(7)
    again = synthetic.normal_customers(ids).unionByName(
        synthetic.fraud_customers(spark.range(10))
    )
    twice = synthetic.orders(synthetic.order_facts(again))
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
