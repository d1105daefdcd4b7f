import pytest
from pyspark.sql import functions as F
from shop import Shop, rows

from tradeloom.plans import readmission, refresh
from tradeloom.session import new_run_folder
from tradeloom.sources import layers as store
from tradeloom.sources.bridge import load_tables

AT = "2026-01-01 00:00:00"


def layers_of(spark, label):
    return store.Layers(new_run_folder(spark, label)).new_version()


def shop(spark, bought="2020-01-15 10:00:00", status="delivered"):
    made = Shop(spark).product("p1", "a").customer("c1").seller("s1").person("c1", "n", "t")
    made.order("o1").item("o1").pay("o1", 10.0)
    return made.order("o2", bought=bought, status=status).item("o2", price=5.0).pay("o2", 7.0)


def mend(open_):
    bought, status = F.col("order_purchase_timestamp"), F.col("order_status")
    return open_.withColumns(
        {"order_purchase_timestamp": F.regexp_replace(bought, "^at ", ""), "order_status": F.rtrim(status, F.lit("?"))}
    )


def open_ids(spark, layers):
    return sorted(r["order_id"] or "" for r in rows(readmission.open_rows(spark, layers, "orders")))


def test_every_broken_rule_is_a_reason(spark):
    made = Shop(spark).order("o1").order("o2", bought="soon", status="lost").order("o3").order("o3")
    made.order(None).order("o4", customer_id=None).order("o5", bought=None)
    told = readmission.with_reasons(made.tables().orders, readmission.RULES["orders"])
    found = sorted((r["order_id"] or "", tuple(r["REASONS"])) for r in rows(told) if r["REASONS"])
    assert found == [
        ("", ("null order_id",)),
        ("o2", ("unreadable order_purchase_timestamp", "unaccepted order_status")),
        ("o3", ("repeated order_id",)),
        ("o3", ("repeated order_id",)),
        ("o4", ("null customer_id",)),
    ]


def test_reject_mend_and_replay_equal_a_clean_run(spark):
    folder = store.Layers(new_run_folder(spark, "back"))
    spoilt = shop(spark, bought="at 2020-01-15 10:00:00", status="delivered?").tables()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        refresh.run_refresh(spark, spoilt, folder, AT)
    first = refresh.run_refresh(spark, spoilt, folder, AT, readmission=True)
    (seller,) = rows(refresh.open_mart(spark, first.layers, "mart_top_sellers"))
    assert (seller["TOTAL_ORDERS"], seller["TOTAL_REVENUE"]) == (1, 10.0)
    assert open_ids(spark, first.layers) == ["o2"]

    readmission.replay(spark, first.layers, "orders", mend)
    assert open_ids(spark, first.layers) == []
    again = refresh.run_refresh(spark, spoilt, folder, AT, readmission=True)
    clean = refresh.run_refresh(spark, shop(spark).tables(), store.Layers(new_run_folder(spark, "clean")), AT)
    for name in ("mart_top_sellers", "mart_revenue_trend", "mart_clientes_top"):
        assert rows(refresh.open_mart(spark, again.layers, name)) == rows(refresh.open_mart(spark, clean.layers, name))
    assert open_ids(spark, again.layers) == []  # logged once more, but let in already


def test_a_second_replay_adds_nothing_and_what_fails_stays_open(spark):
    layers = layers_of(spark, "twice")
    made = Shop(spark).order("o1").order("o2", status="shipped?").order("o3", bought="yesterday")
    kept = readmission.set_aside(made.tables(), layers)
    for _ in range(2):
        readmission.replay(spark, layers, "orders", mend)
        whole = readmission.with_admitted(spark, kept, layers).orders
        assert sorted((r["order_id"], r["order_status"]) for r in rows(whole)) == [("o1", "delivered"), ("o2", "shipped")]
        assert open_ids(spark, layers) == ["o3"]
    mended = lambda open_: open_.withColumn("order_purchase_timestamp", F.lit("2020-01-01 00:00:00"))
    readmission.replay(spark, layers, "orders", mended)
    assert open_ids(spark, layers) == []


def test_an_unpublished_replay_counts_for_nothing(spark, monkeypatch):
    layers = layers_of(spark, "cut")
    kept = readmission.set_aside(Shop(spark).order("o1").order("o2", status="shipped?").tables(), layers)

    def broken(*_):
        raise RuntimeError("cut off")

    with monkeypatch.context() as patched:
        patched.setattr(readmission, "append_rows", broken)
        with pytest.raises(RuntimeError, match="cut off"):
            readmission.replay(spark, layers, "orders", mend)
    assert open_ids(spark, layers) == ["o2"]
    readmission.replay(spark, layers, "orders", mend)
    assert readmission.with_admitted(spark, kept, layers).orders.count() == 2


def test_repeated_keys_come_back_once_chosen(spark):
    layers = layers_of(spark, "chosen")
    made = Shop(spark).order("o1").order("o2").order("o2", status="shipped").order("o3").order("o3")
    kept = readmission.set_aside(made.tables(), layers)
    assert [r["order_id"] for r in rows(kept.orders)] == ["o1"]
    assert open_ids(spark, layers) == ["o2", "o2", "o3", "o3"]
    one_each = lambda open_: open_.orderBy("order_status").dropDuplicates(["order_id"])
    readmission.replay(spark, layers, "orders", one_each)
    whole = readmission.with_admitted(spark, kept, layers).orders
    assert sorted(r["order_id"] for r in rows(whole)) == ["o1", "o2", "o3"]
    assert open_ids(spark, layers) == ["o2"]  # the row that was not chosen
    readmission.replay(spark, layers, "orders", one_each)
    assert readmission.with_admitted(spark, kept, layers).orders.count() == 3


def test_a_row_that_its_source_mends_wins(spark):
    layers = layers_of(spark, "source")
    readmission.set_aside(Shop(spark).order("o1", status="shipped?").tables(), layers)
    readmission.replay(spark, layers, "orders", mend)
    later = Shop(spark).order("o1", status="canceled").tables()
    whole = readmission.with_admitted(spark, readmission.set_aside(later, layers), layers)
    assert [r["order_status"] for r in rows(whole.orders)] == ["canceled"]


def test_equal_rows_all_come_back_and_tables_may_be_empty(spark):
    layers = layers_of(spark, "equal")
    made = Shop(spark)
    for _ in range(3):
        made.review("o1", 5, answered="at 2020-01-01 00:00:00")
    kept = readmission.set_aside(made.tables(), layers)
    readable = F.regexp_replace("review_answer_timestamp", "^at ", "")
    readmission.replay(spark, layers, "order_reviews", lambda open_: open_.withColumn("review_answer_timestamp", readable))
    readmission.replay(spark, layers, "orders", mend)
    whole = readmission.with_admitted(spark, kept, layers)
    assert whole.order_reviews.count() == 3 and whole.orders.count() == 0


def test_refused_rows_are_not_sent_to_the_driver(spark):
    layers = layers_of(spark, "log")
    t = load_tables(spark, "/root/testdata/sf0.001")
    spoilt = t.orders.withColumn("order_status", F.concat("order_status", F.lit("?")))
    readmission.set_aside(t.with_raw(orders=spoilt), layers)
    opened = readmission.open_rows(spark, layers, "orders")
    plan = spark._jvm.PythonSQLUtils.explainString(opened._jdf.queryExecution(), "simple")
    assert plan.count("SortMergeJoin [DIGEST") == 2
    assert opened.count() == t.orders.count()
