"""Marts kept up to date from mergeable states of months.

The lines of delivered orders are stored by the month of purchase. Of each month a state is
kept per seller and per category: sums, and the set of its products. A delivery adds its
lines to their months; the states of those months alone are made again from their lines, and
a mart merges the states of all months, which is far less than the lines.

- An order is of one month and comes with one delivery, so distinct orders of months add up.
  The first line that an order has of a seller, and of a category, is marked when it is
  stored: counting orders again is adding marks.
- Products recur, so their sets are united. Products have dense numbers from a dictionary
  that only grows; a set is stored in pieces of 32,768 numbers: a bitmap where it holds more
  than FEW of them, else a list. Lists meet bitmaps bit by bit, so sparse sets stay small.
  Lines are stored with the numbers of their products instead of their ids.
- Everything is written by month folders; a run that is cut off is run again for its months.

Sellers and their places are looked up when a mart is merged, one row per seller. A category
is that of its line's delivery. Lines of orders without purchase moment make a month of their
own, as the models count them; lines without product count in sums and orders only. Lines
stored before they had numbers and marks have to be stored again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.functions.money import exact_sum
from tradeloom.operators.lookups import lookup_join
from tradeloom.operators.rollups import distinct_rollup
from tradeloom.plans.history import MONTH_KEY
from tradeloom.plans.lines import delivered_orders, labelled_products
from tradeloom.plans.sales import category_report
from tradeloom.plans.sellers import SELLER, seller_report
from tradeloom.sources.tables import Tables

LINES_DDL = f"""
    order_id string, seller_id string, CATEGORY string, price double, number bigint,
    opens_sellers int, opens_categories int, {MONTH_KEY} string"""
DICTIONARY_DDL = "product_id string, number bigint, slot int"
#: The states: by what they are kept. Buckets in which products are numbered.
STATES = {"sellers": "seller_id", "categories": "CATEGORY"}
SLOTS = 256
#: Most members of a piece of a set that is stored as a list.
FEW = 512
#: The month of lines without purchase moment.
NO_MONTH = "none"


@dataclass(frozen=True)
class Store:
    """Folders of the stored lines, the dictionary and the states."""

    root: str

    def lines(self) -> str:
        return f"{self.root}/lines"

    def dictionary(self) -> str:
        return f"{self.root}/dictionary"

    def totals(self, state: str) -> str:
        return f"{self.root}/{state}/totals"

    def products(self, state: str) -> str:
        return f"{self.root}/{state}/products"


def delivered_lines(t: Tables, dictionary: DataFrame) -> DataFrame:
    """All item rows of delivered orders with category, product number and month of purchase.

    The category is null where the product is unknown: such a line has no place in the
    category models, but has one in those of sellers. `opens_<state>` is 1 on one line of
    an order per key of the state, else null.
    """
    labels = labelled_products(t).where("product_id is not null").distinct()
    products = dictionary.select("product_id", "number").join(labels, "product_id", "left")
    items = lookup_join(t.order_items.select("order_id", "product_id", "seller_id", "price"), products, "product_id", "left", derived=True)
    month = F.coalesce(F.date_format("purchased_at", "yyyy-MM"), F.lit(NO_MONTH))
    orders = delivered_orders(t).select("order_id", month.alias(MONTH_KEY))
    lines = items.drop("product_id").join(orders, "order_id")
    for state, key in STATES.items():
        of_order = Window.partitionBy("order_id", MONTH_KEY, key).orderBy("number")
        lines = lines.withColumn(f"opens_{state}", F.when(F.row_number().over(of_order) == 1, 1))
    marks = [f"opens_{state}" for state in STATES]
    return lines.select("order_id", "seller_id", "CATEGORY", "price", "number", *marks, MONTH_KEY)


def open_lines(spark: SparkSession, store: Store, months: list[str] | None = None) -> DataFrame:
    lines = spark.read.schema(LINES_DDL).parquet(store.lines())
    return lines if months is None else lines.where(F.col(MONTH_KEY).isin(months))


def _stored(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def number_products(lines: DataFrame, store: Store) -> None:
    """Give new products of the lines numbers behind those of the dictionary.

    Products are numbered within SLOTS buckets: the n-th of slot s is n * SLOTS + s + 1.
    """
    spark = lines.sparkSession
    new = lines.where("product_id is not null").select("product_id").distinct()
    slot = F.pmod(F.xxhash64("product_id"), F.lit(SLOTS)).cast("int")
    taken = spark.createDataFrame([], "slot int, taken bigint")
    if _stored(spark, store.dictionary()):
        known = open_dictionary(spark, store)
        new = new.join(known, "product_id", "left_anti")
        taken = known.groupBy("slot").agg(F.count("*").alias("taken"))
    place = F.row_number().over(Window.partitionBy("slot").orderBy("product_id"))
    new = new.withColumn("slot", slot).withColumn("place", place).join(taken, "slot", "left")
    number = (F.coalesce("taken", F.lit(0)) + F.col("place") - 1) * SLOTS + F.col("slot") + 1
    new.select("product_id", number.cast("bigint").alias("number"), "slot").write.mode("append").parquet(store.dictionary())


def open_dictionary(spark: SparkSession, store: Store) -> DataFrame:
    return spark.read.schema(DICTIONARY_DDL).parquet(store.dictionary())


def add_delivery(t: Tables, store: Store) -> list[str]:
    """Store the lines of a delivery by month; the months that have changed.

    Orders come once (see `load_arrivals` for repeated ones), with all their items.
    """
    number_products(t.order_items, store)
    lines, seen = delivered_lines(t, open_dictionary(t.order_items.sparkSession, store)), Observation()
    told = lines.observe(seen, F.collect_set(MONTH_KEY).alias("months"))
    told.repartition(MONTH_KEY).write.mode("append").partitionBy(MONTH_KEY).parquet(store.lines())
    return sorted(seen.get.get("months") or [])


def refresh_states(spark: SparkSession, store: Store, months: list[str]) -> None:
    """Make the states of some months again from the lines of those months."""
    lines = open_lines(spark, store, months)
    for state, key in STATES.items():
        kept = lines.where(F.col(key).isNotNull()) if state == "categories" else lines
        totals = distinct_rollup(kept, [MONTH_KEY, key], f"opens_{state}", measures={"price": F.col("price")}, unique=True)
        _replace_months(totals.select(MONTH_KEY, key, "n", "price_sum", "price_cnt"), store.totals(state))
        members = lines.where(F.col("number").isNotNull() & F.col(key).isNotNull())
        _replace_months(product_sets(members, [MONTH_KEY, key]), store.products(state))


def _replace_months(rows: DataFrame, path: str) -> None:
    writer = rows.write.mode("overwrite").partitionBy(MONTH_KEY)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def product_sets(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key and piece the numbers it holds: `few` as a list, or `bits` as a bitmap."""
    cells = rows.select(*keys, F.bitmap_bucket_number("number").alias("piece"), F.bitmap_bit_position("number").cast("int").alias("bit"))
    cells = cells.groupBy(*keys, "piece").agg(F.collect_set("bit").alias("few"))
    places = cells.where(F.size("few") > FEW).select(*keys, "piece", F.explode(F.col("few").cast("array<bigint>")).alias("bit"))
    dense = places.groupBy(*keys, "piece").agg(F.bitmap_construct_agg("bit").alias("bits"))
    sparse = cells.where(F.size("few") <= FEW).select(*keys, "piece", F.lit(None).cast("binary").alias("bits"), "few")
    return sparse.unionByName(dense.withColumn("few", F.lit(None).cast("array<int>")))


def bit_is_set(bits: Column, bit: Column) -> Column:
    """Whether a bitmap holds a place; bytes are read as two hexadecimal digits."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("getbit", byte, (bit % 8).cast("int")) == 1


def united_sizes(sets: DataFrame, key: str) -> DataFrame:
    """Per key how many numbers its sets of all months hold together (`n_product_id`)."""
    dense = sets.where("bits is not null").groupBy(key, "piece").agg(F.bitmap_or_agg("bits").alias("bits"))
    sparse = sets.where("few is not null").select(key, "piece", F.explode("few").alias("bit")).distinct()
    outside = F.col("bits").isNull() | ~bit_is_set(F.col("bits"), F.col("bit"))
    beyond = sparse.join(dense, [key, "piece"], "left").where(outside).groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    sizes = dense.select(key, F.bitmap_count("bits").alias("size")).unionByName(beyond)
    return sizes.groupBy(key).agg(F.sum("size").alias("n_product_id"))


def merged_state(spark: SparkSession, store: Store, state: str) -> DataFrame:
    """Per key: n_order_id, n_product_id, price_sum and price_cnt over all months."""
    key = STATES[state]
    totals = spark.read.schema(f"{key} string, n bigint, price_sum double, price_cnt bigint, {MONTH_KEY} string").parquet(store.totals(state))
    sums = totals.groupBy(key).agg(F.sum("n").alias("n_order_id"), exact_sum(F.col("price_sum")).alias("price_sum"), F.sum("price_cnt").alias("price_cnt"))
    sets = spark.read.schema(f"{key} string, piece bigint, bits binary, few array<int>, {MONTH_KEY} string").parquet(store.products(state))
    united = sums.join(united_sizes(sets, key), key, "left")
    return united.withColumn("n_product_id", F.coalesce("n_product_id", F.lit(0)))


def top_sellers_merged(t: Tables, store: Store, limit: int = 20) -> DataFrame:
    """`mart_top_sellers` from the states; one row per seller in the seller table."""
    places = t.sellers.select("seller_id", F.col("seller_city").alias("CITY"), F.col("seller_state").alias("STATE"))
    spark = t.sellers.sparkSession
    rolled = lookup_join(merged_state(spark, store, "sellers"), places, "seller_id")
    return seller_report(rolled.select(*SELLER, "n_order_id", "n_product_id", "price_sum", "price_cnt"), limit)


def top_categories_merged(spark: SparkSession, store: Store, limit: int = 10) -> DataFrame:
    """`mart_top_categories` from the states."""
    return category_report(merged_state(spark, store, "categories"), limit)
