"""The deliveries that `event_driven_revenue` makes of the given tables."""

from tradeloom.plans import registry
from tradeloom.sources import layers as store
from tradeloom.sources.bridge import load_tables

SF_DIR = "/root/testdata/sf0.001"


def test_payments_get_their_moments_once_for_all_deliveries(spark, monkeypatch):
    plans, delivered = [], {"orders": [], "payments": []}

    def appended(df, path):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        delivered[path.rsplit("/", 1)[1]].append(df.collect())

    monkeypatch.setattr(store, "append_rows", appended)
    for name in ("complete_until", "revenue_on_arrival", "told_days"):
        monkeypatch.setattr(registry.revenue, name, lambda *a: None)
    registry.revenue_arrived(spark, SF_DIR)
    assert len(plans) == 6 and not any("Join" in p or "Union" in p for p in plans)
    t = load_tables(spark, SF_DIR)
    for name, table, keys in (("orders", t.orders, ["order_id"]), ("payments", t.order_payments, ["order_id", "payment_sequential"])):
        wanted = {}
        for row in table.select(*keys).collect():
            wanted[tuple(row)] = 2 if int(row["order_id"]) % 6 == 0 else 1
        found = {}
        for row in (r for part in delivered[name] for r in part):
            key = tuple(row[k] for k in keys)
            found[key] = found.get(key, 0) + 1
        assert found == wanted and all(delivered[name])
    # What is late: every 9th order of the second half of the month before a cut.
    months = [{r["order_purchase_timestamp"][:7] for r in part if int(r["order_id"]) % 9} for part in delivered["orders"]]
    assert max(months[0]) < "1997-03" <= min(months[1]) and max(months[1]) < "1999-05" <= min(months[2])
