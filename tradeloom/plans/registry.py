"""Registered queries: every model and job as a function of (spark, sf_dir).

Jobs that write use a fresh folder below the one named in `spark.checkpoint.dir`
and return what was stored, read back.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from tradeloom.functions.identity import card_token, cpf, cpf_is_valid
from tradeloom.operators import quality
from tradeloom.plans import fraud, history, pareto, partials, readmission, refresh, sales, sellers, synthetic
from tradeloom.plans.catalog import ANALYSES, FRAUD_RULES, MARTS, STAGING, Builder
from tradeloom.schemas import SOURCE_TABLES, TEXT_LIMITS, contract
from tradeloom.session import new_run_folder, remove_folder
from tradeloom.sources import keyed
from tradeloom.sources import layers as store
from tradeloom.sources.bridge import Bridge, load_tables
from tradeloom.sources.landing import read_csv_folder
from tradeloom.sources.tables import Tables
from tradeloom.streaming import arrivals, revenue

# A fixed detection moment keeps the fraud result comparable between runs.
DETECTED_AT = "2026-01-01 06:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def _model(build: Builder) -> Query:
    return lambda spark, sf_dir: build(load_tables(spark, sf_dir))


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


#: Checksums are kept below this prime.
CHECKSUM_BELOW = 1_000_000_007


def _hashed(field: StructField) -> Column:
    """A whole number per value that another engine can compute alike."""
    value, kind = F.col(field.name), field.dataType.simpleString()
    if kind == "boolean":
        return value.cast("int").cast("bigint")
    if kind not in ("string", "timestamp", "timestamp_ntz"):
        return F.round(value.cast("double") * 10_000).cast("bigint")
    text = value if kind == "string" else F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def table_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, non-null values and an order-free checksum of every column of every table."""
    return _stack([_column_checks(name, frame) for name, frame in tables.items()])


def mart_checks(spark: SparkSession, layers: store.Layers, names: Iterable[str]) -> DataFrame:
    """The same of stored marts.

    A list of names is hashed once per card: hashing it for each customer of the card would
    grow with the square of those.
    """
    lists = StructField("NAMES_LIST", StringType())
    marts = {name: refresh.open_mart(spark, layers, name, digest=_hashed(lists)) for name in names}
    return _stack([_column_checks(name, frame, hashed={"NAMES_LIST"}) for name, frame in marts.items()])


def _column_checks(name: str, frame: DataFrame, hashed: Collection[str] = ()) -> DataFrame:
    """Columns named in `hashed` hold what `_hashed` makes of the values."""
    sums = [
        F.struct(
            F.lit(field.name).alias("COLUMN_NAME"),
            F.count(field.name).alias("VALUE_COUNT"),
            (F.sum((F.col(field.name) if field.name in hashed else _hashed(field)).cast("decimal(20,0)")) % CHECKSUM_BELOW).cast("bigint").alias("CHECKSUM"),
        )
        for field in frame.schema.fields
    ]
    found = frame.agg(F.count(F.lit(1)).alias("ROW_COUNT"), F.array(*sums).alias("columns"))
    return found.select(F.lit(name).alias("TABLE_NAME"), "ROW_COUNT", F.inline("columns"))


# --- sources, sinks, materialisation -------------------------------------------


def csv_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the source tables as CSV files and read the folder back, typed."""
    t, folder = load_tables(spark, sf_dir), new_run_folder(spark, "csv")
    for name in SOURCE_TABLES:
        getattr(t, name).write.option("header", True).csv(f"{folder}/{name}.csv")
    landed = {name: opener() for name, opener in read_csv_folder(spark, folder).items()}
    return table_checks(landed)


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table holds the last write only."""
    t, path = load_tables(spark, sf_dir), f"{new_run_folder(spark, 'replace')}/pay"
    store.replace_table(t.order_payments.where("payment_value < 0"), path)
    store.replace_table(t.order_payments, path)
    return store.open_table(spark, path, "order_payments")


def appended_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table grows by every append."""
    t, path = load_tables(spark, sf_dir), f"{new_run_folder(spark, 'append')}/pay"
    first = F.col("payment_sequential") == 1
    store.append_rows(t.order_payments.where(first), path)
    store.append_rows(t.order_payments.where(~first), path)
    return store.open_table(spark, path, "order_payments")


def filtered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column of the rows that satisfy a predicate, both pushed to the scan."""
    t, path = load_tables(spark, sf_dir), f"{new_run_folder(spark, 'filter')}/customers"
    store.replace_table(t.customers_extended, path)
    stored = store.open_table(spark, path, "customers_extended")
    return stored.where("is_synthetic").select("customer_id")


def created_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the extended customer table twice, fill it, rely on its defaults."""
    t, path = load_tables(spark, sf_dir), new_run_folder(spark, "create")
    table = "extended_" + path.rsplit("-", 1)[1]
    store.create_extended_customers(spark, table, path)
    store.create_extended_customers(spark, table, path)
    given = [c for c in t.customers_extended.columns if c not in store.EXTENDED_DEFAULTS]
    spark.sql(
        f"insert into {table} ({', '.join(given)}) select {', '.join(given)} from {{rows}}",
        rows=t.customers_extended,
    )
    spark.sql(f"drop table {table}")  # the catalog entry only; the files are external
    return store.open_table(spark, path, "customers_extended")


def synced_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy all source tables to the raw layer and measure the copies."""
    layers = store.Layers(new_run_folder(spark, "raw"))
    names = store.sync_raw(load_tables(spark, sf_dir), layers)
    return table_checks(store.raw_tables(spark, layers, names).by_name())


def synced_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw copy with the order-keyed tables bucketed on the order id, measured."""
    layers = store.Layers(new_run_folder(spark, "bucketed"))
    database = "raw_" + layers.root.rsplit("-", 1)[1]
    spark.sql(f"create database {database} location '{layers.root}/catalog'")
    source = load_tables(spark, sf_dir)  # sizes the shuffles
    store.sync_raw_bucketed(source, layers, database, buckets=max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return table_checks(store.bucketed_tables(spark, layers, database).by_name())


def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between two synchronisations of the payments, keyed by their order.

    Some orders go, some come, some payments get another value.
    """
    payments, number = load_tables(spark, sf_dir).order_payments, F.col("order_id").cast("bigint")
    table = keyed.KeyedTable(new_run_folder(spark, "payments"), ("order_id",), depth=1)
    dearer = F.when(number % 983 == 0, F.col("payment_value") + 1).otherwise(F.col("payment_value"))
    first, _ = keyed.synchronise(payments.where(number % 997 != 0), table)
    second, _ = keyed.synchronise(payments.where(number % 991 != 0).withColumn("payment_value", dearer), table)
    return keyed.changes_between(spark, table, first, second)


def upserted_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extended customers, of which some come later or move, delivered twice."""
    people, number = load_tables(spark, sf_dir).customers_extended, F.col("customer_id").cast("bigint")
    table = keyed.KeyedTable(new_run_folder(spark, "people"), ("customer_id",), depth=1)
    keyed.upsert(people.where(number % 3 != 0), table)
    moved = F.when(number % 10 == 3, F.concat("customer_city", F.lit("_new"))).otherwise(F.col("customer_city"))
    delivery = people.where((number % 3 == 0) | (number % 10 == 3)).withColumn("customer_city", moved)
    for _ in range(2):
        keyed.upsert(delivery, table)
    return keyed.open_version(spark, table)


def source_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared source by its registered view name."""
    views = store.register_sources(spark, load_tables(spark, sf_dir))
    return table_checks({view: spark.table(view) for view in views})


def staging_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging model, queried by view name."""
    load_tables(spark, sf_dir).stg_orders.createOrReplaceTempView("stg_orders")
    return spark.sql(
        """select ORDER_STATUS, count(*) as ORDERS, min(ORDER_PURCHASED_AT) as FIRST_AT,
               max(ORDER_PURCHASED_AT) as LAST_AT
           from stg_orders group by ORDER_STATUS"""
    )


def stored_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart as stored table, read back with its contract."""
    t, layers = load_tables(spark, sf_dir), store.Layers(new_run_folder(spark, "mart"))
    refresh.store_mart(t, layers, "mart_top_sellers", sellers.top_sellers)
    return refresh.open_mart(spark, layers, "mart_top_sellers")


def _refreshed(spark: SparkSession, sf_dir: str) -> store.Layers:
    layers = store.Layers(new_run_folder(spark, "refresh"))
    refresh.run_refresh(spark, load_tables(spark, sf_dir), layers, DETECTED_AT)
    return store.published(spark, layers)


def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole refresh, all checks on; every column of the published marts checked."""
    layers = _refreshed(spark, sf_dir)
    return mart_checks(spark, layers, MARTS)


def daily_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole refresh, all checks on; rows per published mart."""
    layers = _refreshed(spark, sf_dir)
    return _stack(
        [
            refresh.open_mart(spark, layers, name)
            .agg(F.count(F.lit(1)).alias("ROW_COUNT"))
            .select(F.lit(name).alias("MODEL"), "ROW_COUNT")
            for name in MARTS
        ]
    )


def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and reviews by whether a timestamp that cannot be read sets them aside.

    The given texts are all readable, so those of every 50th order and of the reviews of
    every 40th are replaced by words first.
    """
    t, layers = load_tables(spark, sf_dir), store.Layers(new_run_folder(spark, "aside"))
    number = F.col("order_id").cast("bigint")
    spoilt = t.with_raw(
        orders=_spoilt(t.orders, "order_purchase_timestamp", number % 50 == 0, "yesterday"),
        order_reviews=_spoilt(t.order_reviews, "review_answer_timestamp", number % 40 == 0, "soon"),
    )
    kept = refresh.set_malformed_aside(spoilt, layers)
    parts = []
    for name, key in (("orders", "order_id"), ("order_reviews", "review_id")):
        aside = store.open_table(spark, layers.rejected(name), name)
        for rows, rejected in ((getattr(kept, name), False), (aside, True)):
            parts.append(rows.select(F.lit(name).alias("TABLE_NAME"), F.col(key).alias("KEY"), F.lit(rejected).alias("REJECTED")))
    return _stack(parts)


def _spoilt(rows: DataFrame, column: str, where: Column, text: str) -> DataFrame:
    return rows.withColumn(column, F.when(where, text).otherwise(F.col(column)))


def readmitted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that are good, back after mending, or still open, with what is wrong with them.

    Of every 50th the purchase text gets a word in front and of every 70th the status a
    mark, both of which mending takes off; the text of every 90th cannot be mended. The
    rows are mended and replayed twice.
    """
    t, layers = load_tables(spark, sf_dir), store.Layers(new_run_folder(spark, "mended")).new_version()
    number, bought, status = F.col("order_id").cast("bigint"), F.col("order_purchase_timestamp"), F.col("order_status")
    text = F.when(number % 90 == 0, "yesterday").when(number % 50 == 0, F.concat(F.lit("at "), bought)).otherwise(bought)
    marked = F.when(number % 70 == 0, F.concat(status, F.lit("?"))).otherwise(status)
    spoilt = t.orders.withColumns({"order_purchase_timestamp": text, "order_status": marked})
    kept = readmission.set_aside(t.with_raw(orders=spoilt), layers)

    def mend(rows: DataFrame) -> DataFrame:
        return rows.withColumns({"order_purchase_timestamp": F.regexp_replace(bought, "^at ", ""), "order_status": F.rtrim(status, F.lit("?"))})

    for _ in range(2):
        readmission.replay(spark, layers, "orders", mend)
    parts = {"good": kept.orders, "back": readmission.admitted_rows(spark, layers, "orders"), "open": readmission.open_rows(spark, layers, "orders")}
    told = {"open": F.array_join("REASONS", ", ")}
    return _stack(
        [
            rows.select("order_id", status, bought, F.lit(state).alias("STATE"), told.get(state, F.lit("")).alias("REASONS"))
            for state, rows in parts.items()
        ]
    )


# --- optional: arrivals, incremental months, customer history ---------------------


def _delivered_twice(spark: SparkSession, sf_dir: str, handle: Callable) -> str:
    """Two deliveries of order files, handled after each; the target folder."""
    orders, root = load_tables(spark, sf_dir).orders, new_run_folder(spark, "arrivals")
    early = F.col("order_id").cast("bigint") % 3 != 0
    for delivery in (orders.where(early), orders.where(~early)):
        store.append_rows(delivery, f"{root}/incoming")
        handle(spark, f"{root}/incoming", f"{root}/target", f"{root}/checkpoint")
    return f"{root}/target"


def arrivals_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged orders of two deliveries, each file handled once."""
    return arrivals.loaded_orders(spark, _delivered_twice(spark, sf_dir, arrivals.load_arrivals))


def arrivals_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by day of purchase, kept up to date over two deliveries."""
    return arrivals.counted_days(spark, _delivered_twice(spark, sf_dir, arrivals.count_arrivals))


def arrivals_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged orders where every file is delivered again, and some of its rows once more.

    The deliveries follow the years, so that state is let go on the way.
    """
    orders, root = load_tables(spark, sf_dir).orders, new_run_folder(spark, "repeated")
    again = F.col("order_id").cast("bigint") % 4 == 0
    year = F.substring("order_purchase_timestamp", 1, 4)
    for years in (year < "1998", year >= "1998", year < "1996"):
        for delivery in (orders.where(years), orders.where(years & again)):
            store.append_rows(delivery, f"{root}/incoming")
        arrivals.load_arrivals(spark, f"{root}/incoming", f"{root}/target", f"{root}/checkpoint", late=revenue.LATE)
    return arrivals.loaded_orders(spark, f"{root}/target")


def revenue_arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by day over three deliveries of orders and payments, then their end.

    Some orders and payments come a delivery late, some come twice. Payments are given
    moments up to 19 days after their orders.
    """
    t, incoming = load_tables(spark, sf_dir), f"{new_run_folder(spark, 'revenue')}/incoming"
    target, checkpoint = f"{incoming}-days", f"{incoming}-state"
    number = F.col("order_id").cast("bigint")
    bought = F.col("order_purchase_timestamp").cast("timestamp_ntz")
    paid_at = F.timestamp_add("DAY", (number % 20).cast("int"), bought)
    payments = t.order_payments.join(t.orders.select("order_id", "order_purchase_timestamp"), "order_id")
    payments = payments.withColumn("paid_at", paid_at.cast("string")).drop("order_purchase_timestamp")
    cuts = ["", "1997-03", "1999-05", "9"]

    def dealt(rows: DataFrame, at: str) -> DataFrame:
        """The rows with their delivery; every 6th order's come twice."""
        # Every 9th order of the days before a cut comes with the delivery after it.
        month = F.substring(at, 1, 7)
        late = (number % 9 == 0) & (F.substring(at, 9, 2) > "15")
        month = F.when(late & (month == "1997-02"), cuts[1]).when(late & (month == "1999-04"), cuts[2]).otherwise(month)
        part = F.when(month >= cuts[2], 2).when(month >= cuts[1], 1).when(month >= cuts[0], 0)
        times = F.when(number % 6 == 0, 2).otherwise(1)
        given = rows.withColumn("part", part).where(month < cuts[3])
        return given.withColumn("time", F.explode(F.sequence(F.lit(1), times))).drop("time")

    # Payments take a join for their moments, which is done once for all deliveries.
    dealt(payments, "paid_at").write.partitionBy("part").parquet(f"{incoming}-dealt")
    drawn = spark.read.schema(f"{revenue.PAYMENTS_DDL}, part int").parquet(f"{incoming}-dealt")
    deliveries = {"orders": dealt(t.orders, "order_purchase_timestamp"), "payments": drawn}
    for part in range(3):
        for name, rows in deliveries.items():
            store.append_rows(rows.where(F.col("part") == part).drop("part"), f"{incoming}/{name}")
        if part == 2:
            revenue.complete_until(spark, incoming, "2002-12-31 00:00:00")
        revenue.revenue_on_arrival(spark, incoming, target, checkpoint)
    return revenue.told_days(spark, target)


def _merged_months(spark: SparkSession, sf_dir: str) -> tuple[Tables, partials.Store]:
    """States of all orders but some of two months, then brought up to date for those."""
    t, kept = load_tables(spark, sf_dir), partials.Store(new_run_folder(spark, "partials"))
    late = (F.col("order_id").cast("bigint") % 3 == 0) & history.month_of_purchase().isin("1995-03", "1997-11")
    for orders in (t.orders.where(~late), t.orders.where(late)):
        delivery = t.with_raw(orders=orders)
        partials.refresh_states(spark, kept, partials.add_delivery(delivery, kept))
    return t, kept


def incremental_top_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best sellers merged from the states of months after a late delivery."""
    return partials.top_sellers_merged(*_merged_months(spark, sf_dir))


def incremental_top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best categories merged from the states of months after a late delivery."""
    return partials.top_categories_merged(spark, _merged_months(spark, sf_dir)[1])


def incremental_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly revenue stored without some orders of 1995, then brought up to date.

    Only the months of the orders that came late are computed and replaced.
    """
    t, path = load_tables(spark, sf_dir), f"{new_run_folder(spark, 'months')}/revenue"
    late = (F.col("order_id").cast("bigint") % 7 == 0) & history.month_of_purchase().startswith("1995")
    history.store_months(t.with_raw(orders=t.orders.where(~late)), path)
    history.store_months(t, path, history.changed_months(t.orders.where(late)))
    return history.open_months(spark, path)


def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses over two snapshots: some customers move, some come, some go."""
    number = F.col("customer_id").cast("bigint")
    people = load_tables(spark, sf_dir).customers
    moved = F.when(number % 10 == 3, F.concat("customer_city", F.lit("_new"))).otherwise(F.col("customer_city"))
    first = history.first_history(people.where(number % 13 != 0), "2025-01-01 00:00:00")
    second = people.where(number % 17 != 0).withColumn("customer_city", moved)
    return history.next_history(first, second, "2026-01-01 00:00:00")


def orders_with_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the customer's address at purchase, after three snapshots of customers."""
    t, number = load_tables(spark, sf_dir), F.col("customer_id").cast("bigint")
    moved = F.when(number % 10 == 3, F.concat("customer_city", F.lit("_new"))).otherwise(F.col("customer_city"))
    told = history.first_history(t.customers.where(number % 13 != 0), "1993-06-01 00:00:00")
    second = t.customers.where(number % 17 != 0).withColumn("customer_city", moved)
    told = history.next_history(told, second, "1995-06-01 00:00:00")
    told = history.next_history(told, t.customers, "1997-06-01 00:00:00")
    return history.orders_with_address(t.stg_orders, told)


# --- data quality ---------------------------------------------------------------


def null_counts(t: Tables) -> DataFrame:
    return quality.not_null(t.stg_orders, contract("stg_orders").names)


def repeated_values(t: Tables) -> DataFrame:
    """Orders with several items, several payments, and repeated order rows."""
    checks = {
        "orders": t.orders,
        "order_items": t.order_items,
        "order_payments": t.order_payments,
    }
    return _stack(
        [
            quality.run_checks(name, frame, quality.Checks(unique=["order_id"]))
            for name, frame in checks.items()
        ]
    )


def unexpected_values(t: Tables) -> DataFrame:
    """Statuses, payment types and scores outside short lists."""
    return _stack(
        [
            quality.accepted_values(t.stg_orders, "ORDER_STATUS", ["delivered", "canceled"]),
            quality.accepted_values(t.order_payments, "payment_type", ["credit_card"]),
            quality.accepted_values(t.order_reviews, "review_score", [1, 2, 3, 4, 5]),
        ]
    )


def long_texts(t: Tables) -> DataFrame:
    """Values beyond the declared text lengths, and beyond lengths cut to three quarters."""
    tight = {column: limit * 3 // 4 for column, limit in TEXT_LIMITS.items()}
    declared = quality.text_limits(t.customers_extended, TEXT_LIMITS)
    return declared.unionByName(quality.text_limits(t.customers_extended, tight))


def contracted(t: Tables) -> DataFrame:
    """The staging model after its contract was enforced, summed up by status."""
    staged = quality.enforce_contract("stg_orders", t.stg_orders, contract("stg_orders"))
    return staged.groupBy("ORDER_STATUS").agg(
        F.count("ORDER_ID").alias("ORDERS"),
        F.count("ORDER_DELIVERED_AT").alias("ARRIVALS"),
    )


def quality_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 55 declared checks over stored staging and mart tables."""
    layers = store.Layers(new_run_folder(spark, "suite"))
    t = load_tables(spark, sf_dir)
    staged = refresh.store_staging(spark, t, layers)
    shared = refresh.store_shared(spark, t.with_stored(stg_orders=staged), layers)
    refresh.store_marts(shared, layers, DETECTED_AT)
    return refresh.quality_report(spark, staged, layers)


# --- synthetic data -------------------------------------------------------------
# Ids come from the given tables: customers become normal, suppliers fraudulent
# synthetic customers, so the generated data grows with the input.


def _normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = Bridge(spark, sf_dir).read("customer").selectExpr("c_custkey as id")
    return synthetic.normal_customers(ids)


def _fraudulent(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = Bridge(spark, sf_dir).read("supplier").selectExpr("s_suppkey as id")
    return synthetic.fraud_customers(ids)


def _synthetic_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    everyone = _normal(spark, sf_dir).unionByName(_fraudulent(spark, sf_dir))
    return synthetic.order_facts(everyone)


#: Marts whose rows the synthetic load changes.
CHANGED_BY_LOAD = [
    "mart_sazonalidade",
    "mart_revenue_trend",
    "mart_seasonal_dates",
    "mart_peak_hours",
    "mart_fraud_signals",
]


def synthetic_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated customers and orders appended to the raw tables, then a refresh.

    Every column of the marts the load changes, checked.
    """
    raw, lake = store.Layers(new_run_folder(spark, "loaded")), store.Layers(new_run_folder(spark, "lake"))
    names = store.sync_raw(load_tables(spark, sf_dir), raw)
    people = _normal(spark, sf_dir).unionByName(_fraudulent(spark, sf_dir))
    facts = synthetic.order_facts(people)
    generated = {
        "customers_extended": people,
        "orders": synthetic.orders(facts),
        "order_items": synthetic.order_items(facts),
        "order_payments": synthetic.order_payments(facts),
        "order_reviews": synthetic.order_reviews(facts),
    }
    for name, rows in generated.items():
        store.append_rows(rows, raw.raw(name))

    def on_step(name: str) -> None:
        # The refresh reads its own copy from here on.
        if name == "raw_sync":
            remove_folder(spark, raw.root)

    refresh.run_refresh(spark, store.raw_tables(spark, raw, names), lake, DETECTED_AT, on_step=on_step)
    current = store.published(spark, lake)
    return mart_checks(spark, current, CHANGED_BY_LOAD)


def _generated(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_synthetic_facts(spark, sf_dir))


def card_tokens(t: Tables) -> DataFrame:
    owner = F.col("customer_id")
    salt = F.substring("document_number", -4, 4)
    return t.customers_extended.select(owner, card_token(owner, salt).alias("card_token"))


def tax_numbers(t: Tables) -> DataFrame:
    """Numbers built from the last nine digits given, and a check of the given ones."""
    given = F.col("document_number")
    built = t.customers_extended.select(
        "customer_id", given, cpf(F.substring(given, -9, 9)).alias("cpf")
    )
    return built.select(
        "customer_id",
        "cpf",
        cpf_is_valid(given).alias("given_is_valid"),
        cpf_is_valid(F.col("cpf")).alias("built_is_valid"),
    )


JOBS: dict[str, Query] = {
    "src_csv_dir": csv_folder,
    "sink_replace": replaced_table,
    "sink_append": appended_table,
    "src_table_filter": filtered_table,
    "sink_create_if_absent": created_table,
    "raw_sync": synced_raw,
    "raw_sync_bucketed": synced_bucketed,
    "raw_sync_changes": changed_rows,
    "sink_upsert": upserted_customers,
    "src_registry": source_registry,
    "mat_view": staging_view,
    "mat_table": stored_mart,
    "pipeline_run": pipeline_run,
    "daily_refresh": daily_refresh,
    "quarantine_split": quarantine_split,
    "quarantine_readmission": readmitted_orders,
    "exact_revenue": _model(sales.exact_revenue),
    "event_driven_load": arrivals_loaded,
    "event_driven_days": arrivals_counted,
    "event_driven_repeats": arrivals_repeated,
    "event_driven_revenue": revenue_arrived,
    "incremental_month": incremental_months,
    "incremental_top_sellers": incremental_top_sellers,
    "incremental_top_categories": incremental_top_categories,
    "scd2_customers": customer_history,
    "scd2_orders": orders_with_address,
    "pareto_products": _model(pareto.pareto_by_product),
    "pareto_customers": _model(pareto.pareto_by_customer),
    "dq_not_null": _model(null_counts),
    "dq_unique": _model(repeated_values),
    "dq_accepted_values": _model(unexpected_values),
    "dq_text_limits": _model(long_texts),
    "dq_contract": _model(contracted),
    "dq_suite": quality_suite,
    "synth_normal_customers": _normal,
    "synth_fraud_customers": _fraudulent,
    "synth_orders": _generated(synthetic.orders),
    "synth_items": _generated(synthetic.order_items),
    "synth_payments": _generated(synthetic.order_payments),
    "synth_reviews": _generated(synthetic.order_reviews),
    "synth_load": synthetic_load,
    "synth_card_token": _model(card_tokens),
    "synth_cpf": _model(tax_numbers),
}


def registered_queries() -> dict[str, Query]:
    builders = {**STAGING, **MARTS, **ANALYSES, **FRAUD_RULES}
    builders["mart_fraud_signals"] = lambda t: fraud.fraud_signals(t, DETECTED_AT)
    return {**{name: _model(build) for name, build in builders.items()}, **JOBS}
