import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradeloom.functions.money import exact_decimal, exact_sum
from tradeloom.operators.rollups import distinct_rollup, dual_distinct_rollup

DDL = "k string, o bigint, p bigint, v double"


def payments(count=20_000):
    """Cents of all sizes, a third of them on one key, to a total of some 1e12."""
    chance = random.Random(5)
    cents = [chance.choice([7, 1_010, 99_999_999, 29_999_999_999, -1_234_567]) + chance.randrange(100) for _ in range(count)]
    keys = ["hot" if i % 3 == 0 else f"k{i % 50}" for i in range(count)]
    return [(key, i % 4_000, i % 77, c / 100) for i, (key, c) in enumerate(zip(keys, cents))], sum(cents)


def dealt(spark, rows):
    """The same rows in three orders and layouts."""
    frame = spark.createDataFrame(rows, DDL)
    yield frame.repartition(1)
    yield frame.repartition(7, "k")
    yield spark.createDataFrame(sorted(rows, key=lambda r: -r[3]), DDL).repartition(13)


def test_totals_do_not_depend_on_the_order_of_rows(spark):
    rows, cents = payments()
    totals = [frame.agg(exact_decimal(F.col("v")).alias("t")).first()["t"] for frame in dealt(spark, rows)]
    assert abs(cents) > 10**13 and set(totals) == {Decimal(cents) / 100}
    by_key = [sorted(map(tuple, frame.groupBy("k").agg(exact_sum(F.col("v"))).collect())) for frame in dealt(spark, rows)]
    assert by_key[0] == by_key[1] == by_key[2]


@pytest.mark.parametrize("unique", [False, True])
def test_rollups_do_not_depend_on_the_order_of_rows(spark, unique):
    rows, _ = payments()
    value = {"v": F.col("v")}
    single = [distinct_rollup(f, ["k"], "o", measures=value, unique=unique).select("k", "n", "v_sum", "v_cnt") for f in dealt(spark, rows)]
    dual = [dual_distinct_rollup(f, ["k"], "o", "p", value).select("k", "n_o", "n_p", "v_sum") for f in dealt(spark, rows)]
    for kind in (single, dual):
        found = [sorted(map(tuple, frame.collect())) for frame in kind]
        assert found[0] == found[1] == found[2]


def test_edges_of_sums(spark):
    one = lambda *values: spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum(F.col("v"))).first()[0]
    assert one() is None and one(None) is None
    assert one(-1.25, None, 0.25) == -1.0
    assert one(*[0.1] * 10) == 1.0
    assert one(1e12, 0.01, -1e12) == 0.01
    assert one(0.0000004, 2.0) == 2.0  # more than six digits behind the point are rounded
    for value in (float("nan"), float("inf"), 1e19):
        with pytest.raises(Exception, match="OVERFLOW|overflow"):
            one(value)
