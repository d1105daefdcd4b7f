"""What a refresh keeps on disk while it runs: slices, turns, and files that go."""

import threading
import time

from pyspark.sql import functions as F
from shop import Shop, rows

from tradeloom.operators.lookups import input_bytes
from tradeloom.plans import refresh, registry
from tradeloom.plans.catalog import MARTS
from tradeloom.session import new_run_folder, tune
from tradeloom.sources import layers as store


def mixed_shop(spark):
    """Sellers and categories over several orders; ids that are unknown, missing or repeated."""
    shop = Shop(spark).customer("c1")
    for i in range(240):
        shop.order(f"o{i}", status="canceled" if i % 7 == 0 else "delivered", delivered="2020-01-20 10:00:00", estimated="2020-01-18 00:00:00")
        for n in range(i % 3 + 1):
            shop.item(f"o{i}", product_id=f"p{(i * 3 + n) % 11}" if n < 2 else None, price=10.0 + i % 13 + n / 10, seller_id=f"s{(i + n) % 5}" if i % 10 else None)
        shop.pay(f"o{i}", 5.0 + i).review(f"o{i}", i % 5 + 1)
    shop.item(None).item("unknown").pay(None, 3.0)
    for k in range(10):
        shop.product(f"p{k}", f"kind{k % 3}" if k else None)
    for k in (0, 1, 2, 3, 3):
        shop.seller(f"s{k}")
    return shop.tables()


def stored_marts(spark, t) -> dict:
    layers = store.Layers(new_run_folder(spark, "slices"))
    raw = store.raw_tables(spark, layers, store.sync_raw(t, layers))
    staged = refresh.store_staging(spark, raw, layers)
    shared = refresh.store_shared(spark, raw.with_stored(stg_orders=staged), layers)
    refresh.store_marts(shared, layers, registry.DETECTED_AT)
    return {name: sorted(map(str, rows(refresh.open_mart(spark, layers, name)))) for name in MARTS}


def test_marts_of_slices_are_those_of_the_whole(spark, monkeypatch):
    t = mixed_shop(spark)
    whole, folders, append = stored_marts(spark, t), [], store.append_rows
    monkeypatch.setattr(refresh, "SLICE_BYTES", 6_000)
    monkeypatch.setattr(refresh, "SIDE_BY_SIDE_BYTES", 1)
    monkeypatch.setattr(refresh, "append_rows", lambda df, path: (folders.append(path.rsplit("/", 1)[1]), append(df, path)))
    assert stored_marts(spark, t) == whole
    assert {"sales_lines", "seller_totals"} <= set(folders)


def test_slices_hold_every_row_once(spark):
    t = mixed_shop(spark)
    for key, name in (("order_id", "order_items"), ("seller_id", "order_items"), ("ORDER_ID", "orders")):
        parts = [getattr(t.slice_of(key, 3, n), name) for n in range(3)]
        together = parts[0].unionAll(parts[1]).unionAll(parts[2])
        given = getattr(t, name)
        assert all(0 < p.count() < given.count() for p in parts)
        assert together.exceptAll(given).count() == 0 and given.exceptAll(together).count() == 0
    assert t.slice_of("order_id", 3, 0).products.count() == t.products.count()


def test_large_statements_take_turns_and_small_ones_do_not(spark):
    def most_at_once(sizes) -> int:
        room, seen, now, lock = refresh.Room(100), [], [], threading.Lock()

        def run(size):
            with room.held(size):
                with lock:
                    now.append(size)
                    seen.append(len(now))
                time.sleep(0.2)
                with lock:
                    now.remove(size)

        threads = [threading.Thread(target=run, args=(size,)) for size in sizes]
        [thread.start() for thread in threads]
        [thread.join(10) for thread in threads]
        assert len(seen) == len(sizes)
        return max(seen)

    assert most_at_once([300, 200, 101]) == 1
    assert most_at_once([10, 0, 20]) == 3
    assert most_at_once([60, 60]) == 1


def test_shuffle_files_go_with_their_statement(spark):
    tune(spark)
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    kept = lambda: {str(b) for b in blocks.getAllBlocks().mkString(" ").split() if b.startswith("shuffle")}
    before = kept()
    grouped = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count()
    store.replace_table(grouped, path := new_run_folder(spark, "grouped"))
    assert kept() <= before
    assert spark.read.parquet(path).count() == 700
    # An answer asked for again is computed again.
    assert [grouped.count(), len(grouped.collect()), len(grouped.collect())] == [700] * 3


def test_stored_texts_take_less_space(spark):
    path = new_run_folder(spark, "texts")
    tune(spark)
    store.replace_table(spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("x")), path)
    # 32 letters of 4 bits each; snappy leaves them as they are.
    assert input_bytes(spark.read.parquet(path)) < 20_000 * 24


def test_the_synthetic_load_keeps_one_copy_of_the_raw_tables(spark, monkeypatch):
    folders, publish = [], refresh.publish
    monkeypatch.setattr(registry, "new_run_folder", lambda spark, label: folders.append(new_run_folder(spark, label)) or folders[-1])
    left = []

    def publishing(spark, layers):
        path = spark._jvm.org.apache.hadoop.fs.Path
        system = path(layers.root).getFileSystem(spark._jsc.hadoopConfiguration())
        left.extend(f for f in folders if system.exists(path(f"{f}/raw/orders")))
        publish(spark, layers)

    monkeypatch.setattr(refresh, "publish", publishing)
    registry.synthetic_load(spark, "/root/testdata/sf0.001")
    assert left == [f for f in folders if "/lake-" in f] and len(folders) == 2
