import os

from shop import Shop, by, rows

from tradeloom.plans import history
from tradeloom.session import new_run_folder


def shop_with(spark, *orders):
    shop = Shop(spark).customer("c1").product("p1", "a")
    for order_id, bought, value, status in orders:
        shop.order(order_id, bought=bought, status=status).pay(order_id, value)
    return shop.tables()


def test_only_changed_months_are_replaced(spark):
    path = new_run_folder(spark, "months")
    january, february, march = "2020-01-05 10:00:00", "2020-02-05 10:00:00", "2020-03-05 10:00:00"
    given = [("o1", january, 1.0, "delivered"), ("o2", february, 2.0, "delivered"), ("o3", march, 4.0, "delivered")]
    history.store_months(shop_with(spark, *given), path)
    local = path.removeprefix("file:")
    before = os.listdir(f"{local}/MONTH_KEY=2020-01")
    later = [given[0], *given[1:2], ("o4", february, 8.0, "delivered"), ("o3", march, 4.0, "canceled")]
    history.store_months(shop_with(spark, *later), path, ["2020-02", "2020-03"])
    assert os.listdir(f"{local}/MONTH_KEY=2020-01") == before
    found = by(history.open_months(spark, path), "MONTH")
    assert {m: r["TOTAL_REVENUE"] for m, r in found.items()} == {1: 1.0, 2: 10.0}


def people(spark, *given):
    return spark.createDataFrame(given, "customer_id string, customer_city string, customer_state string")


def test_addresses_are_closed_and_opened(spark):
    first = people(spark, ("stays", "a", "S"), ("moves", "a", "S"), ("goes", "a", "S"), ("none", None, "S"), (None, "x", "S"))
    second = people(spark, ("stays", "a", "S"), ("moves", "b", "S"), ("comes", "c", "S"), ("none", None, "S"), ("stays", "a", "S"))
    start = history.first_history(first, "2025-01-01 00:00:00")
    told = history.next_history(start, second, "2026-01-01 00:00:00")
    seen = sorted(
        (r["customer_id"], r["customer_city"] or "", r["VALID_FROM"].year, r["VALID_TO"] and r["VALID_TO"].year, r["IS_CURRENT"])
        for r in rows(told)
    )
    assert seen == [
        ("comes", "c", 2026, None, True),
        ("goes", "a", 2025, 2026, False),
        ("moves", "a", 2025, 2026, False),
        ("moves", "b", 2026, None, True),
        ("none", "", 2025, None, True),
        ("stays", "a", 2025, None, True),
    ]
    again = history.next_history(told, second, "2027-01-01 00:00:00")
    assert again.exceptAll(told).count() == 0 and told.exceptAll(again).count() == 0
