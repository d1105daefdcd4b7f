"""Revenue on arrival against the batch model: late, repeated and cut-off deliveries."""

import datetime as dt
import random

import pytest
from shop import Shop, by

from tradeloom.plans.seasonality import seasonal_dates
from tradeloom.schemas import RAW_DDL
from tradeloom.session import new_run_folder
from tradeloom.sources.layers import append_rows
from tradeloom.streaming import arrivals, revenue

START = dt.datetime(2020, 1, 1, 9)


@pytest.fixture()
def place(spark):
    root = new_run_folder(spark, "stream")
    return {"incoming": f"{root}/in", "target": f"{root}/out", "checkpoint": f"{root}/state"}


def shop_rows(seed: int, days: int, orders: int):
    """Raw orders and payments with moments; some orders have several payments, some none."""
    draw = random.Random(seed)
    bought, paid = [], []
    for i in range(orders):
        at = START + dt.timedelta(days=draw.randrange(days), minutes=draw.randrange(800))
        status = "canceled" if i % 11 == 0 else "delivered"
        bought.append((f"o{i}", "c1", status, str(at), None, None, None, None))
        for n in range(draw.randrange(4)):
            paid.append((f"o{i}", n + 1, "card", 1, draw.randrange(1, 9000) / 100, str(at + dt.timedelta(days=draw.randrange(20)))))
    return bought, paid


def deliver(spark, place, orders=(), payments=()):
    for name, rows, ddl in (("orders", orders, RAW_DDL["orders"]), ("payments", payments, revenue.PAYMENTS_DDL)):
        append_rows(spark.createDataFrame(list(rows), ddl).coalesce(1), f"{place['incoming']}/{name}")


def batch_days(spark, orders, payments) -> dict:
    shop = Shop(spark)
    shop.rows["orders"], shop.rows["order_payments"] = list(orders), [p[:5] for p in payments]
    return by(seasonal_dates(shop.tables()), "ORDER_DATE")


def told(spark, place) -> dict:
    return by(revenue.told_days(spark, place["target"]), "ORDER_DATE")


def finish(spark, place):
    revenue.complete_until(spark, place["incoming"], "2021-12-31 00:00:00")
    return revenue.revenue_on_arrival(spark, **place)


def test_three_deliveries_out_of_order_equal_the_batch(spark, place):
    orders, payments = shop_rows(1, 60, 400)
    draw, days_seen = random.Random(2), []
    cut = lambda row, at: min(2, max(0, (dt.datetime.fromisoformat(row[at]) - START).days // 25 + draw.choice((0, 0, 1))))
    order_part, payment_part = [cut(o, 3) for o in orders], [cut(p, 5) for p in payments]
    states = []
    for part in range(3):
        new_orders = [o for o, at in zip(orders, order_part) if at == part]
        new_payments = [p for p, at in zip(payments, payment_part) if at == part]
        draw.shuffle(new_orders)
        deliver(spark, place, new_orders, new_payments)
        states.append(revenue.revenue_on_arrival(spark, **place))
        days_seen.append(set(told(spark, place)))
    last = finish(spark, place)
    assert told(spark, place) == batch_days(spark, orders, payments)
    assert all(p.dropped == 0 for p in states)
    assert days_seen[0] <= days_seen[1] <= days_seen[2]
    # Only the marks of the last delivery are left in state.
    assert states[-1].state_rows > 300 and last.state_rows <= 4


def test_state_is_let_go_while_the_stream_goes_on(spark, place):
    sizes = []
    for month in range(1, 7):
        days = [f"2020-{month:02d}-{day:02d} 12:00:00" for day in range(1, 28)]
        rows = [(f"o{d}", "c1", "delivered", d, None, None, None, None) for d in days]
        deliver(spark, place, rows, [(o[0], 1, "card", 1, 1.0, o[3]) for o in rows])
        sizes.append(revenue.revenue_on_arrival(spark, **place).state_rows)
    assert max(sizes) < 2.2 * sizes[2] and len(told(spark, place)) > 60


def test_files_delivered_again_and_runs_without_files_change_nothing(spark, place):
    orders, payments = shop_rows(3, 20, 120)
    for _ in range(2):
        deliver(spark, place, orders, payments)
        revenue.revenue_on_arrival(spark, **place)
    deliver(spark, place, orders, [(*p[:5], str(dt.datetime.fromisoformat(p[5]) + dt.timedelta(days=9))) for p in payments])
    finish(spark, place)
    wanted = batch_days(spark, orders, payments)
    assert told(spark, place) == wanted
    # All state is gone now; what comes again is late.
    deliver(spark, place, orders, payments)
    again = revenue.revenue_on_arrival(spark, **place)
    assert told(spark, place) == wanted and again.dropped > 0
    assert revenue.revenue_on_arrival(spark, **place).batches == 0


def test_a_batch_that_failed_after_its_write_is_run_again(spark, place, monkeypatch):
    orders, payments = shop_rows(5, 10, 60)
    deliver(spark, place, orders, payments)
    revenue.complete_until(spark, place["incoming"], "2021-12-31 00:00:00")
    whole = revenue.store_batch

    def cut_off(rows, batch, target):
        whole(rows, batch, target)
        if rows.count():
            raise RuntimeError("executor gone")

    monkeypatch.setattr(revenue, "store_batch", cut_off)
    with pytest.raises(Exception, match="executor gone"):
        revenue.revenue_on_arrival(spark, **place)
    monkeypatch.setattr(revenue, "store_batch", whole)
    revenue.revenue_on_arrival(spark, **place)
    assert told(spark, place) == batch_days(spark, orders, payments)


def test_awkward_rows_belong_to_no_day(spark, place):
    good = ("o1", "c1", "delivered", "2020-01-05 23:59:59", None, None, None, None)
    odd = [("o2", "c1", "delivered", at, None, None, None, None) for at in (None, "soon")] + [(None, None, "delivered", good[3], None, None, None, None)]
    pay = [("o1", 1, "card", 1, 5.0, "2020-01-05 23:59:58"), ("o1", 2, "card", 1, None, "2020-01-07 00:00:00"), ("o1", 3, "card", 1, 7.0, None), ("o1", 4, "card", 1, 7.0, "2020-03-07 00:00:00"), (None, 1, "card", 1, 9.0, good[3])]
    deliver(spark, place, [good, *odd, good], pay)
    finish(spark, place)
    assert [(str(d), r["TOTAL_ORDERS"], r["TOTAL_REVENUE"]) for d, r in told(spark, place).items()] == [("2020-01-05 00:00:00", 1, 5.0)]


def test_days_do_not_depend_on_the_session_time_zone(spark, place):
    orders, payments = shop_rows(7, 4, 30)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        deliver(spark, place, orders, payments)
        finish(spark, place)
        assert told(spark, place) == batch_days(spark, orders, payments)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_orders_delivered_again_are_loaded_once(spark, place):
    orders, _ = shop_rows(9, 30, 100)
    for part in (orders[:70], orders[40:], orders[:10]):
        append_rows(spark.createDataFrame(part, RAW_DDL["orders"]), place["incoming"])
        arrivals.load_arrivals(spark, **place, late="40 days")
    loaded = [r["ORDER_ID"] for r in arrivals.loaded_orders(spark, place["target"]).collect()]
    assert sorted(loaded) == sorted(o[0] for o in orders)


def test_counts_of_the_last_batch_are_read(spark, place):
    orders, _ = shop_rows(11, 5, 40)
    for part in (orders[:20], orders[20:]):
        append_rows(spark.createDataFrame(part, RAW_DDL["orders"]), place["incoming"])
        arrivals.count_arrivals(spark, **place)
    days = arrivals.counted_days(spark, place["target"]).collect()
    assert sum(r["TOTAL_ORDERS"] for r in days) == 40 and len({r["ORDER_DATE"] for r in days}) == len(days)
