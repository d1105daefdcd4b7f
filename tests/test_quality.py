import pytest
from shop import Shop, rows

from tradeloom.operators import quality
from tradeloom.plans.catalog import ALL_CHECKS, MART_CHECKS, MARTS, STAGING_CHECKS
from tradeloom.schemas import TEXT_LIMITS, contract


def frame(spark):
    return spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "z")], "k int, v string")


def test_check_counts(spark):
    df = frame(spark)
    checks = quality.Checks(not_null=["k", "v"], unique=["k"], accepted={"v": ["a"]})
    report = {
        (r["CHECK_NAME"], r["COLUMN_NAME"]): r["FAILURES"]
        for r in rows(quality.run_checks("m", df, checks))
    }
    assert report == {
        ("not_null", "k"): 1,
        ("not_null", "v"): 1,
        ("unique", "k"): 1,
        ("accepted_values", "v"): 2,
    }


def test_empty_table_passes(spark):
    df = frame(spark).limit(0)
    checks = quality.Checks(not_null=["k"], unique=["k"], accepted={"v": ["a"]})
    assert all(r["FAILURES"] == 0 for r in rows(quality.run_checks("m", df, checks)))


def test_text_limits(spark):
    long = spark.createDataFrame([("SPX",), ("SP",), (None,)], "customer_state string")
    (row,) = rows(quality.text_limits(long, {"customer_state": TEXT_LIMITS["customer_state"]}))
    assert row["FAILURES"] == 1


def test_contract_names_types_and_order(spark):
    df = frame(spark)
    assert quality.enforce_contract("m", df, df.schema) is df
    for other in ("k int, v int", "v string, k int", "k int", "k int, v string, w int"):
        declared = type(df.schema).fromDDL(other)
        with pytest.raises(quality.ContractError):
            quality.enforce_contract("m", df, declared)


@pytest.mark.parametrize("name", list(MARTS))
def test_marts_meet_their_contracts(spark, name):
    t = Shop(spark).tables()
    assert quality.contract_differences(MARTS[name](t), contract(name)) == []


def test_declared_check_numbers():
    assert sum(c.count() for c in MART_CHECKS.values()) == 51
    assert sum(c.count() for c in STAGING_CHECKS.values()) == 4
    assert set(ALL_CHECKS) == {"stg_orders", *MARTS}
