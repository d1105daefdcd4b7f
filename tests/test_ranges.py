"""Running totals, neighbours and as-of joins over ranges, against plain Python."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import ranges

ORDER = lambda: [F.col("v").desc_nulls_last(), F.col("id")]


def values(spark, given):
    rows = [(i, None if v is None else Decimal(v)) for i, v in enumerate(given)]
    return spark.createDataFrame(rows, "id long, v decimal(18,2)")


def sorted_rows(given):
    return sorted(enumerate(given), key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))


CASES = [[], [5], [None, None], [3, 1, 2, 2, 2, None, -4, 0], [7] * 200, [random.Random(1).randint(-5, 5) for _ in range(300)]]


@pytest.mark.parametrize("given", CASES)
def test_running_totals(spark, given):
    found = ranges.running_totals(values(spark, given), ORDER(), {"v": F.col("v")})
    told = {r.id: (r.v_so_far, r.v_whole) for r in found.collect()}
    so_far, whole = 0, sum(v or 0 for v in given)
    assert len(told) == len(given)
    for i, v in sorted_rows(given):
        so_far += v or 0
        assert told[i] == (so_far, whole)


@pytest.mark.parametrize("given", CASES)
def test_previous_row_across_borders(spark, given):
    found = ranges.with_previous(values(spark, given), ORDER(), "v", "before")
    told, before = {r.id: r.before for r in found.collect()}, None
    assert len(told) == len(given)
    for i, v in sorted_rows(given):
        assert told[i] == before
        before = v


FACTS, HISTORY = "k string, at int, n int, payload string", "k string, since int, city string, note string"


def brute(facts, history):
    told = []
    for k, at, n, p in facts:
        past = [(s, (c, o)) for key, s, c, o in history if key == k and None not in (key, s, at) and s <= at]
        known = max(past, key=lambda x: (x[0], tuple((v is not None, v or "") for v in x[1])))[1] if past else (None, None)
        told.append((k, at, n, p, *known))
    return sorted(told, key=repr)


def met(spark, facts, history):
    found = ranges.as_of(spark.createDataFrame(facts, FACTS), spark.createDataFrame(history, HISTORY), "k", "at", "since", ["city", "note"])
    return sorted(map(tuple, found.collect()), key=repr)


def test_as_of_awkward_rows(spark):
    history = [("a", 1, "x", None), ("a", 5, "y", "n"), ("a", 5, "z", None), ("b", 3, None, "only"), (None, 1, "q", "q"), ("a", None, "r", "r")]
    facts = [("a", at, 0, "p") for at in (0, 1, 1, 4, 5, 9)] + [("b", 2, 1, None), ("b", 3, 1, ""), ("c", 3, 1, "long" * 9999), (None, 3, 1, "p"), ("a", None, 1, "p")]
    assert met(spark, facts, history) == brute(facts, history)
    assert met(spark, facts, []) == brute(facts, [])
    assert met(spark, [], history) == []


@pytest.mark.parametrize("seed", range(3))
def test_as_of_with_a_hot_key(spark, seed):
    draw = random.Random(seed)
    key = lambda: "hot" if draw.random() < 0.5 else f"k{draw.randint(0, 9)}"
    history = [(key(), draw.randint(0, 200), draw.choice("uvw"), None) for _ in range(120)]
    facts = [(key(), draw.randint(-5, 210), n, "p") for n in range(600)]
    assert met(spark, facts, history) == brute(facts, history)


def test_a_hot_key_is_spread_over_ranges(spark):
    rows = spark.range(8000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    dealt = ranges.in_ranges(rows, [F.col("k"), F.col("id")])
    sizes = [r["count"] for r in dealt.groupBy(ranges.RANGE).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * 8000 / 4
    assert dealt.where("k = 'hot'").select(ranges.RANGE).distinct().count() >= 2
