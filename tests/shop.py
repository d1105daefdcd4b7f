"""A tiny shop for hand-computed answers: tables from short row tuples."""

from __future__ import annotations

from tradeloom.schemas import RAW_DDL
from tradeloom.sources.tables import Tables


class Shop:
    """Collects rows and turns them into `Tables`."""

    def __init__(self, spark):
        self.spark = spark
        self.rows = {name: [] for name in RAW_DDL}

    def order(
        self,
        order_id,
        customer_id="c1",
        status="delivered",
        bought="2020-01-15 10:00:00",
        delivered=None,
        estimated=None,
    ):
        self.rows["orders"].append(
            (order_id, customer_id, status, bought, None, None, delivered, estimated)
        )
        return self

    def item(self, order_id, product_id="p1", price=10.0, seller_id="s1"):
        self.rows["order_items"].append(
            (order_id, 1, product_id, seller_id, None, price, 0.0)
        )
        return self

    def pay(self, order_id, value, kind="credit_card", installments=1):
        self.rows["order_payments"].append((order_id, 1, kind, installments, value))
        return self

    def review(self, order_id, score, created=None, answered=None, review_id=None):
        self.rows["order_reviews"].append(
            (review_id or f"r-{order_id}", order_id, score, None, None, created, answered)
        )
        return self

    def customer(self, customer_id, city="Town", state="SP"):
        self.rows["customers"].append((customer_id, city, state))
        return self

    def seller(self, seller_id, city="Town", state="SP"):
        self.rows["sellers"].append((seller_id, city, state))
        return self

    def product(self, product_id, category=None):
        self.rows["products"].append((product_id, category))
        return self

    def translate(self, category, english):
        self.rows["translation"].append((category, english))
        return self

    def person(self, customer_id, name, token, state="SP", city="Town"):
        self.rows["customers_extended"].append(
            (customer_id, name, None, None, None, token, "1234", True, None, None, None)
            + (state, city, None, True, "synthetic_2019")
        )
        return self

    def tables(self) -> Tables:
        return Tables.of(
            **{
                name: self.spark.createDataFrame(rows, RAW_DDL[name])
                for name, rows in self.rows.items()
            }
        )


def rows(df) -> list[dict]:
    return [row.asDict() for row in df.collect()]


def by(df, key) -> dict:
    return {row[key]: row.asDict() for row in df.collect()}
