"""All models over tables with nulls and repeated rows, against their plain SQL."""

from pathlib import Path

import duckdb
import pytest
from oracle_check import compare
from pyspark.sql import functions as F

from tradeloom.oracle.bridge_sql import CTES
from tradeloom.oracle.models_sql import MODEL_SQL
from tradeloom.plans import fraud
from tradeloom.plans.catalog import ANALYSES, FRAUD_RULES, MARTS
from tradeloom.plans.registry import DETECTED_AT
from tradeloom.sources.bridge import load_tables
from tradeloom.sources.layers import open_table
from tradeloom.sources.tables import Tables

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")

# Raw table -> CTE of the SQL side that holds it.
RAW = {
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


def every(column: str, step: int):
    return F.pmod(F.xxhash64(column), F.lit(step)) == 0


def nulled(df, column: str, when):
    return df.withColumn(column, F.when(~when, F.col(column)))


def awkward(t: Tables) -> dict:
    """Repeated dimension rows; facts without product, order, value or score."""
    frames = {name: getattr(t, name) for name in RAW}
    for name, key in (("customers", "customer_id"), ("sellers", "seller_id"), ("products", "product_id")):
        frames[name] = frames[name].union(frames[name].where(every(key, 2)))
    items = nulled(frames["order_items"], "product_id", every("order_id", 10))
    frames["order_items"] = nulled(items, "order_id", every("shipping_limit_date", 15))
    pay = nulled(frames["order_payments"], "payment_value", every("order_id", 11))
    frames["order_payments"] = nulled(pay, "order_id", every("payment_value", 13))
    frames["order_reviews"] = nulled(frames["order_reviews"], "review_score", every("review_id", 7))
    people = nulled(frames["customers_extended"], "full_name", every("customer_id", 5))
    frames["customers_extended"] = people.union(people.where(every("customer_id", 3)))
    return frames


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("awkward")
    con = duckdb.connect()
    for name, frame in awkward(load_tables(spark, SF_DIR)).items():
        frame.coalesce(1).write.parquet(f"{folder}/{name}")
        con.execute(f"create view awkward_{name} as select * from '{folder}/{name}/*.parquet'")
    t = Tables({name: lambda name=name: open_table(spark, f"{folder}/{name}", name) for name in RAW})
    return t, con


BUILDERS = {**MARTS, **ANALYSES, **FRAUD_RULES}


@pytest.mark.parametrize("name", list(BUILDERS))
def test_model_matches_sql(both, name):
    t, con = both
    given = {cte: f"select * from awkward_{raw}" for raw, cte in RAW.items()}
    parts = {k: v for k, v in {**CTES, **given}.items() if k not in ("facts", "people")}
    listed = ", ".join(f"{cte} as ({text})" for cte, text in parts.items())
    build = BUILDERS[name]
    frame = fraud.fraud_signals(t, DETECTED_AT) if name == "mart_fraud_signals" else build(t)
    assert compare(frame, con, f"with {listed} {MODEL_SQL[name]}") == ""
