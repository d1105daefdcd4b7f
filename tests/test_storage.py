import re

import pytest
from pyspark.sql import functions as F
from shop import Shop, rows

from tradeloom.operators.lookups import input_bytes
from tradeloom.plans import refresh, registry, sales
from tradeloom.plans.lines import paid_lines
from tradeloom.plans.catalog import ANALYSES, MARTS
from tradeloom.schemas import SOURCE_TABLES, raw_schema
from tradeloom.session import (
    FIRST_PARTITIONS,
    fit_shuffles,
    new_run_folder,
    remove_run_folders,
    shuffle_partitions_for,
    size_shuffles,
    tune,
)
from tradeloom.sources import layers as store
from tradeloom.sources.bridge import Bridge, load_tables
from tradeloom.sources.landing import malformed_in_folder, read_csv_folder
from tradeloom.sources.tables import Tables

SF_DIR = "/root/testdata/sf0.001"


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "shop_orders_dataset.csv").write_text(
        '"order_status","order_id","extra","customer_id","order_purchase_timestamp",'
        '"order_approved_at","order_delivered_carrier_date",'
        '"order_delivered_customer_date","order_estimated_delivery_date"\n'
        '"delivered","o1","x","c1","2020-01-01 10:00:00","","","",""\n'
    )
    (tmp_path / "shop_order_reviews_dataset.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"two\nlines, ""quoted""",2020-01-02 00:00:00,\n'
    )
    (tmp_path / "unknown.csv").write_text("a,b\n1,2\n")
    openers = read_csv_folder(spark, str(tmp_path), prefix="shop_", suffix="_dataset")
    assert set(openers) == {"orders", "order_reviews", "unknown"}
    orders = openers["orders"]()
    assert orders.select(raw_schema("orders").names).schema == raw_schema("orders")
    (order,) = rows(orders)
    assert order["order_id"] == "o1" and order["order_approved_at"] is None
    assert order["extra"] == "x" and orders.columns[2] == "extra"
    (review,) = rows(openers["order_reviews"]())
    assert review["review_comment_message"] == 'two\nlines, "quoted"'
    assert review["review_score"] == 5
    assert openers["unknown"]().columns == ["a", "b"]


def test_missing_csv_column_is_an_error(spark, tmp_path):
    (tmp_path / "customers.csv").write_text("customer_id\nc1\n")
    with pytest.raises(Exception, match="customer_city"):
        read_csv_folder(spark, str(tmp_path))["customers"]()


def customer_parts(tmp_path, second: str) -> str:
    folder = tmp_path / "customers.csv"
    folder.mkdir()
    header = "customer_id,customer_city,customer_state,customer_zip_code_prefix\n"
    (folder / "part-0.csv").write_text(header + "c1,town,SP,01000\n")
    (folder / "part-1.csv").write_text(second)
    return str(tmp_path)


def test_part_files_with_another_header_are_refused(spark, tmp_path):
    other = "customer_state,customer_id,customer_city,customer_zip_code_prefix\nRJ,c2,village,02000\n"
    opener = read_csv_folder(spark, customer_parts(tmp_path, other))["customers"]
    with pytest.raises(Exception, match="header"):
        opener().collect()


def test_rows_that_do_not_fit_are_refused_or_set_aside(spark, tmp_path):
    short = "customer_id,customer_city,customer_state,customer_zip_code_prefix\nc2\nc3,city,RJ,03000\n"
    folder = customer_parts(tmp_path, short)
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv_folder(spark, folder)["customers"]().collect()
    good = read_csv_folder(spark, folder, malformed="skip")["customers"]()
    assert sorted(r["customer_id"] for r in rows(good)) == ["c1", "c3"]
    assert good.count() == 2
    (bad,) = rows(malformed_in_folder(spark, folder)["customers"])
    assert bad["TABLE_NAME"] == "customers" and bad["RECORD"] == "c2"


def test_a_raw_copy_keeps_undeclared_columns_and_tables(spark, tmp_path):
    (tmp_path / "customers.csv").write_text("customer_id,customer_city,customer_state,zip\nc1,town,SP,01000\n")
    (tmp_path / "notes.csv").write_text("a,b\n1,2\n")
    folder = store.Layers(new_run_folder(spark, "whole"))
    names = store.sync_raw(Tables(read_csv_folder(spark, str(tmp_path))), folder)
    assert sorted(names) == ["customers", "notes"]
    assert rows(spark.read.parquet(folder.raw("customers")))[0]["zip"] == "01000"
    assert rows(store.open_table(spark, folder.raw("notes"), "notes")) == [{"a": "1", "b": "2"}]
    assert store.open_table(spark, folder.raw("customers"), "customers").columns == raw_schema("customers").names


def test_filter_and_columns_reach_the_scan(spark):
    path = new_run_folder(spark, "pushdown")
    shop = Shop(spark).person("c1", "n", "t")
    store.replace_table(shop.tables().customers_extended, path)
    found = (
        store.open_table(spark, path, "customers_extended")
        .where("is_synthetic")
        .select("customer_id")
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_synthetic,true)" in plan
    assert "ReadSchema: struct<customer_id:string,is_synthetic:boolean>" in plan


def test_bucketed_order_tables_join_without_shuffle(spark):
    spark.sql("create database if not exists lake")
    folder = store.Layers(new_run_folder(spark, "bucketed"))
    source = load_tables(spark, SF_DIR)
    store.sync_raw_bucketed(source, folder, "lake", buckets=4)
    t = store.bucketed_tables(spark, folder, "lake")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        paid = paid_lines(t)
        plan = paid._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        report = sales.revenue_trend(t).exceptAll(sales.revenue_trend(source))
        assert report.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_extended_table_enforces_text_lengths(spark):
    path = new_run_folder(spark, "lengths")
    store.create_extended_customers(spark, "lengths", path)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):
        spark.sql("insert into lengths (customer_id, customer_state) values ('c', 'SPX')")
    spark.sql("insert into lengths (customer_id, customer_state) values ('c', 'SP')")
    (row,) = rows(spark.table("lengths"))
    assert row["is_synthetic"] is True and row["data_source"] == "synthetic_2019"


def small_shop(spark):
    shop = Shop(spark).product("p1", "a").customer("c1").seller("s1")
    return shop.order("o1").item("o1").pay("o1", 10.0).person("c1", "n", "t")


def test_refresh_runs_steps_in_order_and_repeats(spark):
    folder = store.Layers(new_run_folder(spark, "refresh"))
    source = small_shop(spark).tables()
    for _ in range(2):
        done = refresh.run_refresh(spark, source, folder, "2026-01-01 00:00:00")
        assert done.steps == ["raw_sync", "staging", "marts", "checks"]
    current = store.published(spark, folder)
    assert current == done.layers
    for name in MARTS:
        assert refresh.open_mart(spark, current, name).count() >= 0
    assert refresh.open_mart(spark, current, "mart_top_sellers").count() == 1
    assert spark.table("stg_orders").count() == 1


def test_refresh_on_bucketed_tables(spark):
    spark.sql("create database if not exists lake_refresh")
    folder = store.Layers(new_run_folder(spark, "bucketed_refresh"))
    source = small_shop(spark).tables()
    done = refresh.run_refresh(spark, source, folder, "2026-01-01 00:00:00", bucketed=("lake_refresh", 2))
    assert refresh.open_mart(spark, done.layers, "mart_top_sellers").count() == 1
    described = {r["col_name"]: r["data_type"] for r in rows(spark.sql("describe extended lake_refresh.orders"))}
    assert described["Num Buckets"] == "2" and "order_id" in described["Bucket Columns"]


def test_a_failing_mart_leaves_the_former_version_readable(spark, monkeypatch):
    folder = store.Layers(new_run_folder(spark, "versions"))
    first = refresh.run_refresh(spark, small_shop(spark).tables(), folder, "2026-01-01 00:00:00")

    def broken(t):
        raise RuntimeError("broken mart")

    monkeypatch.setitem(MARTS, "mart_peak_hours", broken)
    with pytest.raises(RuntimeError, match="broken mart"):
        refresh.run_refresh(spark, small_shop(spark).order("o2").tables(), folder)
    current = store.published(spark, folder)
    assert current == first.layers
    assert refresh.open_mart(spark, current, "mart_sazonalidade").count() == 1
    assert refresh.open_mart(spark, current, "mart_peak_hours").count() == 1


def test_refresh_stops_before_marts_when_staging_fails(spark):
    folder = store.Layers(new_run_folder(spark, "stopped"))
    shop = small_shop(spark).order("o1").order("o2", status="lost")
    seen = []
    with pytest.raises(refresh.CheckFailed, match="ORDER_ID unique"):
        refresh.run_refresh(spark, shop.tables(), folder, on_step=seen.append)
    assert seen == ["raw_sync"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        store.published(spark, folder)


def test_quarantine_moves_malformed_rows_to_the_error_layer(spark):
    folder = store.Layers(new_run_folder(spark, "quarantine"))
    shop = small_shop(spark).order("bad", bought="yesterday").review("o1", 5, answered="soon")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        refresh.run_refresh(spark, shop.tables(), folder)
    refresh.run_refresh(spark, shop.tables(), folder, quarantine=True)
    rejected = store.open_table(spark, folder.rejected("orders"), "orders")
    assert [r["order_id"] for r in rows(rejected)] == ["bad"]
    reviews = store.open_table(spark, folder.rejected("order_reviews"), "order_reviews")
    assert [r["review_answer_timestamp"] for r in rows(reviews)] == ["soon"]
    assert [r["ORDER_ID"] for r in rows(spark.table("stg_orders"))] == ["o1"]


def test_shuffles_are_sized_by_input_unless_set(spark):
    assert shuffle_partitions_for(0, cores=8) == 8
    assert shuffle_partitions_for(0, cores=8000) == 200
    assert shuffle_partitions_for(1 << 40, cores=8) == 4096
    assert shuffle_partitions_for(100 << 40, cores=8000) == 409_600
    before = spark.conf.get("spark.sql.shuffle.partitions")
    size_shuffles(spark, "somewhere", lambda: 100 << 40)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_marts_from_the_stored_staging_push_the_status_filter(spark):
    folder = store.Layers(new_run_folder(spark, "staged"))
    t = load_tables(spark, SF_DIR)
    stored = t.with_stored(stg_orders=refresh.store_staging(spark, t, folder))
    plan = MARTS["mart_peak_hours"](stored)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ORDER_STATUS,delivered)" in plan
    assert "ReadSchema: struct<ORDER_ID:string,ORDER_STATUS:string,ORDER_PURCHASED_AT" in plan


def test_an_application_removes_its_own_run_folders(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("tradeloom.session.shared_folder", lambda spark: str(tmp_path))
    other = tmp_path / "another-application"
    other.mkdir()
    spark.range(3).write.parquet(new_run_folder(spark, "left"))
    remove_run_folders(spark)
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["another-application"]


def test_source_names():
    assert len(SOURCE_TABLES) == 9


def test_partitions_stay_small_while_tables_grow(spark):
    for gigabytes in (1, 6, 30):
        assert (gigabytes << 30) / shuffle_partitions_for(gigabytes << 30, cores=12) <= 8 << 20
    assert shuffle_partitions_for(1 << 20, cores=12) == 12
    tune(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_a_task_reads_a_bounded_part_of_a_large_file(spark):
    split = "spark.sql.files.maxPartitionBytes"
    fresh = spark.newSession()
    tune(fresh)
    path = new_run_folder(spark, "large")
    # Lines of random text, as sizes of splits follow those of files.
    spark.range(1 << 20).selectExpr("uuid() as a", "uuid() as b").coalesce(1).write.parquet(path)
    fresh.conf.set("spark.sql.files.minPartitionNum", "1")
    found = fresh.read.schema("a string, b string").parquet(path)
    size, tasks = input_bytes(found), found.rdd.getNumPartitions()
    assert size > 33 << 20 and size / tasks <= 32 << 20
    own = spark.newSession()
    own.conf.set(split, "64m")
    tune(own)
    assert own.conf.get(split) == "64m"


def test_buckets_follow_the_size_of_the_tables(spark, monkeypatch):
    given = {}
    monkeypatch.setattr(registry.store, "sync_raw_bucketed", lambda *_, buckets: given.update(buckets=buckets))
    monkeypatch.setattr(registry.store, "bucketed_tables", lambda *_: Tables({}))
    monkeypatch.setattr(registry, "table_checks", lambda tables: None)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        registry.synced_bucketed(spark, SF_DIR)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert given["buckets"] == 48


def test_a_list_of_names_is_hashed_once_per_card(spark):
    layers = store.Layers(new_run_folder(spark, "names"))
    refresh.store_fraud(load_tables(spark, SF_DIR), layers, "2026-01-01 06:00:00")
    plain = refresh.open_mart(spark, layers, "mart_fraud_signals")
    told = registry.mart_checks(spark, layers, ["mart_fraud_signals"])
    assert sorted(told.collect()) == sorted(registry.table_checks({"mart_fraud_signals": plain}).collect())
    digest = refresh.open_mart(spark, layers, "mart_fraud_signals", digest=F.md5("NAMES_LIST"))
    plan = spark._jvm.PythonSQLUtils.explainString(digest._jdf.queryExecution(), "simple")
    # Below the join, on the side of the cards.
    assert plan.index("md5") > plan.index("Join")


@pytest.fixture
def small_again(spark):
    yield
    fit_shuffles(spark, "small", lambda: 1 << 20)


def test_shuffles_begin_with_enough_partitions_where_the_session_sets_their_number(spark, small_again):
    given = spark.conf.get("spark.sql.shuffle.partitions")
    for gigabytes in (1, 6):
        fit_shuffles(spark, f"{gigabytes} GB", lambda: gigabytes << 30)
        assert int(spark.conf.get(FIRST_PARTITIONS)) == gigabytes * 128
        assert spark.conf.get("spark.sql.shuffle.partitions") == given
    fit_shuffles(spark, "small", lambda: 1 << 20)
    assert spark.conf.get(FIRST_PARTITIONS, None) is None


def test_a_session_keeps_the_number_of_first_partitions_it_sets(spark, small_again):
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.conf.set(FIRST_PARTITIONS, "7")
    fit_shuffles(session, "large", lambda: 1 << 30)
    assert session.conf.get(FIRST_PARTITIONS) == "7"


@pytest.mark.parametrize(
    "name",
    ["mart_top_sellers", "mart_reviews_by_category", "mart_top_categories", "a07_installments_by_category", "a01_top_categories_by_revenue"],
)
def test_lines_of_large_tables_are_joined_in_many_partitions(spark, monkeypatch, small_again, name):
    monkeypatch.setattr(Bridge, "size", lambda self: 6 << 30)
    build = (MARTS | ANALYSES)[name]
    plan = build(load_tables(spark, f"{SF_DIR}/"))._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert shuffles and all(x.endswith(", 768") for x in shuffles)


def test_a_refresh_fits_shuffles_to_the_tables_it_stored(spark, monkeypatch, small_again):
    monkeypatch.setattr(refresh, "input_bytes", lambda frame: 1 << 30)
    seen = []
    monkeypatch.setattr(refresh, "store_staging", lambda *_: seen.append(spark.conf.get(FIRST_PARTITIONS)) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh.run_refresh(spark, load_tables(spark, SF_DIR), store.Layers(new_run_folder(spark, "large")))
    assert int(seen[0]) >= 9 * 128
