"""Marts merged from states of months, against the models over all rows."""

import random
import re
from pathlib import Path

import pytest
from shop import Shop, rows

from tradeloom.plans import partials
from tradeloom.plans.sales import top_categories
from tradeloom.plans.sellers import top_sellers
from tradeloom.session import new_run_folder


def shop_of(spark, orders, products=40):
    """A shop of the given orders; the same items and places for the same order number."""
    shop = Shop(spark).customer("c1")
    for i in range(7):
        shop.seller(f"s{i}", city=f"city{i % 3}")
    for i in range(products):
        shop.product(f"p{i}", f"cat{i % 4}")
    for i in orders:
        draw = random.Random(i)
        status = "canceled" if i % 13 == 0 else "delivered"
        bought = None if i % 50 == 0 else f"2020-{i % 6 + 1:02d}-1{i % 9} 10:00:00"
        shop.order(f"o{i}", bought=bought, status=status)
        for _ in range(draw.randrange(4)):
            product = draw.choice([f"p{draw.randrange(products)}"] * 9 + ["unknown", None])
            shop.item(f"o{i}", product, draw.randrange(100, 99999) / 100, draw.choice(["s0", "s0", f"s{draw.randrange(7)}", "elsewhere"]))
    return shop.tables()


@pytest.fixture()
def kept(spark):
    return partials.Store(new_run_folder(spark, "partials"))


def local(path: str) -> Path:
    return Path(path.removeprefix("file:"))


def merged(spark, tables, kept):
    return rows(partials.top_sellers_merged(tables, kept)), rows(partials.top_categories_merged(spark, kept))


def whole(tables):
    return rows(top_sellers(tables)), rows(top_categories(tables))


@pytest.mark.parametrize("few", [0, 3, 512])
def test_deliveries_of_any_months_equal_the_models(spark, kept, monkeypatch, few):
    monkeypatch.setattr(partials, "FEW", few)
    parts = [range(0, 300), range(300, 302), [i for i in range(302, 420) if i % 6 == 2]]
    for orders in parts:
        months = partials.add_delivery(shop_of(spark, orders), kept)
        partials.refresh_states(spark, kept, months)
    tables = shop_of(spark, [i for part in parts for i in part])
    assert merged(spark, tables, kept) == whole(tables)


def test_lines_of_other_months_are_not_read(spark, kept):
    partials.refresh_states(spark, kept, partials.add_delivery(shop_of(spark, range(200)), kept))
    before = {p: p.stat().st_mtime_ns for p in local(kept.root).glob("s*/*/MONTH_KEY=2020-0[12456]/*")}
    late = [i for i in range(200, 300) if i % 6 == 2]
    months = partials.add_delivery(shop_of(spark, late), kept)
    assert set(months) <= {"2020-03", partials.NO_MONTH}
    read = partials.open_lines(spark, kept, months)._jdf.queryExecution()
    plan = spark._jvm.PythonSQLUtils.explainString(read, "formatted")
    assert re.search(r"PartitionFilters: \[.*MONTH_KEY", plan)
    # Even unreadable lines elsewhere don't matter.
    spoilt = [p for p in local(kept.lines()).glob("MONTH_KEY=2020-0[12456]/*.parquet")]
    assert spoilt
    for path in spoilt:
        path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
        path.write_bytes(b"not a table")
    partials.refresh_states(spark, kept, months)
    assert {p: p.stat().st_mtime_ns for p in local(kept.root).glob("s*/*/MONTH_KEY=2020-0[12456]/*")} == before
    tables = shop_of(spark, [*range(200), *late])
    assert merged(spark, tables, kept) == whole(tables)


def test_a_refresh_that_is_run_again_changes_nothing(spark, kept):
    tables = shop_of(spark, range(120))
    months = partials.add_delivery(tables, kept)
    for _ in range(2):
        partials.refresh_states(spark, kept, months)
    assert merged(spark, tables, kept) == whole(tables)


def test_numbers_are_dense_and_stay(spark, kept):
    first = shop_of(spark, range(200), products=300).order_items
    partials.number_products(first, kept)
    old = {r.product_id: r.number for r in partials.open_dictionary(spark, kept).collect()}
    partials.number_products(shop_of(spark, range(400), products=900).order_items, kept)
    new = {r.product_id: r.number for r in partials.open_dictionary(spark, kept).collect()}
    assert old.items() <= new.items() and len(set(new.values())) == len(new) and min(new.values()) >= 1
    # A slot is filled without holes.
    by_slot = {}
    for number in new.values():
        by_slot.setdefault((number - 1) % partials.SLOTS, []).append((number - 1) // partials.SLOTS)
    assert all(sorted(places) == list(range(len(places))) for places in by_slot.values())


def test_sets_of_lists_and_bitmaps_are_united(spark, monkeypatch):
    monkeypatch.setattr(partials, "FEW", 2)
    members = {("a", 1): [1, 8, 9, 40_000], ("a", 2): [8, 32_768], ("a", 3): [2, 40_000], ("b", 1): [7], ("b", 2): [7, 32_769]}
    given = [(key, month, n) for (key, month), numbers in members.items() for n in numbers]
    sets = partials.product_sets(spark.createDataFrame(given, "key string, month int, number bigint"), ["month", "key"])
    assert {r["n_product_id"] for r in rows(partials.united_sizes(sets, "key")) if r["key"] == "a"} == {6}
    assert {r["n_product_id"] for r in rows(partials.united_sizes(sets, "key")) if r["key"] == "b"} == {2}


def test_no_lines_at_all(spark, kept):
    tables = shop_of(spark, [])
    assert partials.add_delivery(tables, kept) == []
    partials.refresh_states(spark, kept, [])


def test_an_order_opens_each_seller_and_category_once(spark, kept):
    tables = shop_of(spark, range(150))
    partials.add_delivery(tables, kept)
    lines = rows(partials.open_lines(spark, kept))
    for mark, key in (("opens_sellers", "seller_id"), ("opens_categories", "CATEGORY")):
        marked = [(r["order_id"], r[key]) for r in lines if r[mark]]
        assert len(marked) == len(set(marked)) and set(marked) == {(r["order_id"], r[key]) for r in lines}


def test_items_are_read_once_for_the_lines_of_a_delivery(spark, kept):
    tables = shop_of(spark, range(60))
    partials.number_products(tables.order_items, kept)
    lines = partials.delivered_lines(tables, partials.open_dictionary(spark, kept))
    leaves = lines._jdf.queryExecution().optimizedPlan().collectLeaves()
    with_sellers = [i for i in range(leaves.size()) if "seller_id" in leaves.apply(i).output().toString()]
    assert len(with_sellers) == 1


def test_sparse_sets_are_united_without_bitmaps(spark):
    sets = partials.product_sets(spark.createDataFrame([("a", 1, 7)], "key string, month int, number bigint"), ["month", "key"])
    plan = spark._jvm.PythonSQLUtils.explainString(partials.united_sizes(sets, "key")._jdf.queryExecution(), "simple")
    # Bitmaps are united of dense sets only; lists are told apart one by one.
    assert "collect_list" not in plan and "explode(few" in plan
