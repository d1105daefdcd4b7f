"""Plan shapes that matter at scale, and skewed inputs against plain definitions."""

import re

import pytest
from pyspark.sql import functions as F
from shop import Shop, by

from tradeloom.operators.lookups import broadcast_limit, input_bytes, lookup_join
from tradeloom.operators.rollups import (
    distinct_rollup,
    dual_distinct_rollup,
    top_with_total,
)
from tradeloom.plans import fraud, reviews, sales
from tradeloom.plans.lines import categorised_items
from tradeloom.plans.catalog import ANALYSES, FRAUD_RULES, MARTS
from tradeloom.sources.bridge import load_tables

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are for tables beyond the broadcast threshold."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", [*MARTS, *ANALYSES, *FRAUD_RULES])
def test_no_cross_join_no_python_no_row_multiplication(spark, name):
    build = {**MARTS, **ANALYSES, **FRAUD_RULES}[name]
    plan = plan_of(build(load_tables(spark, SF_DIR)))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "ArrowEval" not in plan
    if not name.startswith(("fraud", "mart_fraud")):  # there on the shared tokens only
        assert "Expand" not in plan


def exchanges(plan: str, keys: str) -> int:
    return sum("Exchange hashpartitioning(" + keys in line for line in plan.splitlines())


def test_rollup_after_order_join_adds_no_shuffle_of_its_own(spark, no_broadcast):
    plan = plan_of(sales.ticket_by_category(load_tables(spark, SF_DIR)))
    # items and products by product, translation lookup, both sides by order, then
    # the category groups; grouping by (category, order) needs no exchange.
    assert exchanges(plan, "order_id") == 2
    assert "hashpartitioning(CATEGORY" in plan
    assert not any(
        "hashpartitioning(" in line and "CATEGORY" in line and "order_id" in line
        for line in plan.splitlines()
    )


def test_large_dimensions_are_not_broadcast(spark, no_broadcast):
    t = load_tables(spark, SF_DIR)
    assert "Broadcast" not in plan_of(sales.top_categories(t))


def test_size_check_uses_input_sizes(spark):
    t = load_tables(spark, SF_DIR)
    assert 0 < input_bytes(t.sellers) < broadcast_limit(t.sellers)
    unknown = spark.createDataFrame([("s1",)], "seller_id string")
    assert input_bytes(unknown) > broadcast_limit(unknown)
    plan = plan_of(lookup_join(t.order_items, t.sellers, "seller_id"))
    assert "BroadcastHashJoin" in plan and "BuildLeft" not in plan


def skewed(spark, n=30_000):
    """A third of all rows on one key, and a third on one order."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), i % 50)).alias("k"),
        F.when(i % 3 == 1, "o-hot").otherwise(F.concat(F.lit("o"), i % 7000)).alias("o"),
        F.concat(F.lit("p"), i % 400).alias("p"),
        (i % 1000).cast("double").alias("x"),
        (i % 11 == 0).alias("f"),
    )


def test_rollup_equals_plain_distinct_counts_under_skew(spark):
    df = skewed(spark)
    ours = distinct_rollup(df, ["k"], "o", flags={"f": F.col("f")}, measures={"x": F.col("x")})
    plain = df.groupBy("k").agg(
        F.count_distinct("o").alias("n"),
        F.count_distinct(F.when(F.col("f"), F.col("o"))).alias("n_f"),
        F.sum("x").alias("x_sum"),
        F.count("x").alias("x_cnt"),
        F.min("x").alias("x_min"),
        F.max("x").alias("x_max"),
    )
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_dual_rollup_equals_plain_distinct_counts_under_skew(spark):
    df = skewed(spark)
    ours = dual_distinct_rollup(df, ["k"], "o", "p", {"x": F.col("x")})
    plain = df.groupBy("k").agg(
        F.count_distinct("o").alias("n_o"),
        F.count_distinct("p").alias("n_p"),
        F.sum("x").alias("x_sum"),
        F.count("x").alias("x_cnt"),
        F.min("x").alias("x_min"),
        F.max("x").alias("x_max"),
    )
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_top_with_total_is_exact(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("s"), "id").alias("s"), (F.col("id") * 7919 % 1000).alias("m")
    )
    best = top_with_total(df, "m", total_of="m", tie_break="s", limit=20)
    expected = df.orderBy(F.desc("m"), "s").limit(20).collect()
    found = best.collect()
    assert [(r.s, r.m) for r in found] == [(r.s, r.m) for r in expected]
    assert {r.total for r in found} == {df.agg(F.sum("m")).first()[0]}


def test_unique_orders_are_counted_in_place(spark, no_broadcast):
    t = load_tables(spark, SF_DIR)
    for name in ("mart_peak_hours", "mart_late_deliveries"):
        plain, direct = MARTS[name](t), MARTS[name](t.with_unique_orders())
        assert "order_id" not in " ".join(re.findall(r"hashpartitioning\([^)]*", plan_of(direct)))
        assert plain.exceptAll(direct).count() == 0 and direct.exceptAll(plain).count() == 0


def test_nulls_are_no_distinct_values(spark):
    rows = [("o1", "a", None, 1.0), ("o1", "a", "p1", 2.0), (None, "a", "p2", 4.0), ("o2", "b", None, 8.0)]
    df = spark.createDataFrame(rows, "o string, k string, p string, x double")
    found = by(dual_distinct_rollup(df, ["k"], "o", "p", {"x": F.col("x")}), "k")
    assert {k: (r["n_o"], r["n_p"], r["x_sum"]) for k, r in found.items()} == {"a": (1, 2, 7.0), "b": (1, 0, 8.0)}


def test_categories_do_not_move_the_products(spark):
    """Part is too large to broadcast, the names derived from it are not."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5KB")
    try:
        t = load_tables(spark, "/root/testdata/sf0.001")
        assert input_bytes(t.translation) > 5 << 10
        plan = plan_of(categorised_items(t))
        assert "BroadcastHashJoin [product_category_name" in plan
        left_side = plan.split("BroadcastExchange")[0]
        assert "hashpartitioning(product_category_name" not in left_side
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_names_of_a_card_are_deduplicated_before_they_meet(spark, no_broadcast):
    shop = Shop(spark).person("c1", "n", "t").person("c2", "m", "t")
    plan = fraud.card_names(shop.tables())._jdf.queryExecution().executedPlan().toString()
    before_list = plan[: plan.index("Scan ExistingRDD")]
    keys = re.findall(r"HashAggregate\(keys=\[([^]]*)\]", before_list)
    assert len(keys[0].split(", ")) == 1 and {len(k.split(", ")) for k in keys} == {1, 2}
    signals = fraud.stored_signals(shop.tables(), "2026-01-01 00:00:00")
    assert "NAMES_LIST" not in signals.columns
    assert "collect" not in signals._jdf.queryExecution().optimizedPlan().toString()


def test_hot_order_with_many_items_and_reviews_emits_no_pairs(spark, no_broadcast):
    """3000 items x 300 reviews of one order would be 900,000 pairs."""
    shop = Shop(spark).product("p1", "a").seller("s1")
    for i in range(100):
        shop.order(f"o{i}").item(f"o{i}").review(f"o{i}", 4)
    for i in range(3000):
        shop.item("o0")
    for i in range(299):
        shop.review("o0", 1, review_id=f"x{i}")
    t = shop.tables()
    (row,) = reviews.reviews_by_category(t).collect()
    total = 99 * 4 + 3001 * (4 + 299 * 1)
    assert row.AVG_SCORE == round(total / (99 + 3001 * 300), 2)
    assert (row.TOTAL_ORDERS, row.ONE_STAR) == (100, 1)


def test_hot_card_token(spark):
    shop = Shop(spark)
    for i in range(900):
        token = "hot" if i % 3 == 0 else f"t{i}"
        shop.person(f"c{i:04d}", f"name {i % 200:03d}", token, state=f"S{i % 9}")
    found = by(fraud.shared_cards(shop.tables()), "CREDIT_CARD_TOKEN")
    assert set(found) == {"hot"}
    names = sorted({f"name {i % 200:03d}" for i in range(0, 900, 3)})
    assert found["hot"]["CUSTOMERS_SHARING_CARD"] == 300
    assert found["hot"]["DIFFERENT_NAMES"] == len(names)
    assert found["hot"]["NAMES_LIST"] == " | ".join(names)


def test_skewed_order_join_is_split_at_run_time(spark, no_broadcast):
    """A third of all items on one order: the join splits it, the counts hold."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = skewed(spark, 90_000).repartition(8)
        named = F.when(F.col("id") == 7000, "o-hot").otherwise(F.concat(F.lit("o"), "id"))
        orders = spark.range(7001).select(named.alias("o"), F.lit(1).alias("one"))
        rolled = distinct_rollup(facts.join(orders, "o"), ["k"], "o", measures={"x": F.col("x")})
        found = {r.k: (r.n, r.x_sum) for r in rolled.collect()}
        assert "skew=true" in plan_of(rolled)
        plain = facts.groupBy("k").agg(F.count_distinct("o").alias("n"), F.sum("x").alias("s"))
        assert found == {r.k: (r.n, r.s) for r in plain.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
