"""The daily refresh: raw copy, staging, marts, checks; any failure stops it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from threading import Condition

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from tradeloom.operators.lookups import input_bytes
from tradeloom.operators.quality import enforce_contract, run_checks, suite
from tradeloom.operators.staging import PARSED_TEXTS, is_malformed
from tradeloom.plans import fraud, sales, sellers
from tradeloom.plans import readmission as mending
from tradeloom.plans.catalog import ALL_CHECKS, MARTS, STAGING_CHECKS, Builder
from tradeloom.plans.lines import SHARED_LINES
from tradeloom.schemas import contract
from tradeloom.session import fit_shuffles
from tradeloom.sources.layers import (
    Layers,
    append_rows,
    bucketed_tables,
    publish,
    raw_tables,
    replace_table,
    sync_raw,
    sync_raw_bucketed,
)
from tradeloom.sources.tables import Tables


#: Frames that are stored before the marts, with the key whose slices make them up.
SHARED = {
    **SHARED_LINES,
    "seller_totals": (sellers.seller_totals, "seller_id"),
    "category_totals": (sales.category_totals, "CATEGORY"),
}
# Input bytes whose shuffle files may lie on disk at once: of a slice of a shared frame, and
# of marts that are built side by side. Shuffled rows take some three times the space of the
# stored ones.
SLICE_BYTES, SIDE_BY_SIDE_BYTES = 1 << 30, 256 << 20


class CheckFailed(RuntimeError):
    """A data-quality check found failing rows."""


@dataclass
class Refresh:
    """What a refresh did, in order."""

    layers: Layers
    steps: list[str] = field(default_factory=list)


def _stop_on_failures(report: DataFrame) -> None:
    bad = report.where("FAILURES > 0").collect()  # at most one row per check
    if bad:
        listed = ", ".join(f"{r.MODEL}.{r.COLUMN_NAME} {r.CHECK_NAME}" for r in bad)
        raise CheckFailed(listed)


def store_staging(spark: SparkSession, t: Tables, layers: Layers) -> DataFrame:
    """Type the orders once for all marts and expose them as view `stg_orders`.

    The view reads typed Parquet, so the text is parsed once per refresh, and the
    marts' status filters and column choices reach the scan.
    """
    staged = enforce_contract("stg_orders", t.stg_orders, contract("stg_orders"))
    path = layers.staging("stg_orders")
    replace_table(staged, path)
    stored = spark.read.schema(contract("stg_orders")).parquet(path)
    stored.createOrReplaceTempView("stg_orders")
    return stored


def store_shared(spark: SparkSession, t: Tables, layers: Layers) -> Tables:
    """Write the joined lines several marts start from, so they are joined once.

    Written tables outlive lost executors and are read with only the columns a
    mart needs. Large inputs are handled in slices of a key, one statement each, so that
    no more than the shuffle files of a slice are on disk.
    """
    stored = {"stg_orders": t.stg_orders}
    for name, (build, key) in SHARED.items():
        path, given = layers.staging(name), t.with_stored(**stored)
        rows = build(given)
        slices = -(-input_bytes(rows) // SLICE_BYTES)
        if slices > 1:
            replace_table(build(given.slice_of(key, slices, 0)), path)
            for number in range(1, slices):
                append_rows(build(given.slice_of(key, slices, number)), path)
        else:
            replace_table(rows, path)
        stored[name] = spark.read.schema(rows.schema).parquet(path)
    return t.with_stored(**stored)


class Room:
    """Lets statements run side by side while their inputs stay below a bound together.

    One that is larger than that runs alone.
    """

    def __init__(self, bound: int):
        self._bound, self._taken, self._changed = bound, 0, Condition()

    @contextmanager
    def held(self, size: int) -> Iterator[None]:
        size = max(size, 1)
        with self._changed:
            self._changed.wait_for(lambda: not self._taken or self._taken + size <= self._bound)
            self._taken += size
        try:
            yield
        finally:
            with self._changed:
                self._taken -= size
                self._changed.notify_all()


def _store(df: DataFrame, path: str, room: Room | None) -> None:
    if room is None:
        replace_table(df, path)
    else:
        with room.held(input_bytes(df)):
            replace_table(df, path)


def store_mart(t: Tables, layers: Layers, name: str, build: Builder, room: Room | None = None) -> None:
    """Build one mart, hold it against its contract, replace the stored table."""
    _store(enforce_contract(name, build(t), contract(name)), layers.mart(name), room)


def store_marts(
    t: Tables, layers: Layers, detected_at: str | None = None, at_once: int = 4
) -> None:
    """Build and store all marts, `at_once` of them submitted together.

    Several marts in flight keep the executors busy during the short last stages
    of each. Large ones take turns, so that the shuffle files of one are gone before the
    next makes its own. The first error is raised.
    """
    builders, room = dict(MARTS), Room(SIDE_BY_SIDE_BYTES)
    del builders["mart_fraud_signals"]
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        jobs = [
            pool.submit(store_mart, t, layers, name, build, room)
            for name, build in builders.items()
        ]
        jobs.append(pool.submit(store_fraud, t, layers, detected_at, room))
        for job in jobs:
            job.result()


def store_fraud(t: Tables, layers: Layers, detected_at: str | None, room: Room | None = None) -> None:
    """Store the fraud mart as customers and, once per card, the list of names."""
    declared = contract("mart_fraud_signals")
    stored = StructType([f for f in declared.fields if f.name != "NAMES_LIST"])
    signals = enforce_contract("mart_fraud_signals", fraud.stored_signals(t, detected_at), stored)
    _store(signals, layers.mart("mart_fraud_signals"), room)
    _store(fraud.card_names(t), layers.mart("mart_fraud_card_names"), room)


def open_mart(spark: SparkSession, layers: Layers, name: str, digest: Column | None = None) -> DataFrame:
    """A stored mart; the fraud mart takes its lists of names on while it is read.

    With `digest`, an expression over NAMES_LIST, it takes that of each list instead.
    """
    declared = contract(name)
    if name != "mart_fraud_signals":
        return spark.read.schema(declared).parquet(layers.mart(name))
    stored = StructType([f for f in declared.fields if f.name != "NAMES_LIST"])
    signals = spark.read.schema(stored).parquet(layers.mart(name))
    names = spark.read.schema("CREDIT_CARD_TOKEN string, NAMES_LIST string").parquet(
        layers.mart("mart_fraud_card_names")
    )
    if digest is not None:
        # Settled per card by the exchange that `with_names` puts between.
        names = names.withColumn("NAMES_LIST", digest)
    return fraud.with_names(signals, names).select(*declared.names)


def quality_report(spark: SparkSession, staged: DataFrame, layers: Layers) -> DataFrame:
    """All declared checks over the stored staging and mart tables."""
    frames = {name: open_mart(spark, layers, name) for name in MARTS}
    return suite({"stg_orders": staged, **frames}, ALL_CHECKS)


def set_malformed_aside(t: Tables, layers: Layers) -> Tables:
    """Move raw orders and reviews with unreadable timestamps to the error layer.

    The rest is staged as usual, so one bad row does not stop the refresh and no row
    is dropped unseen.
    """
    good = {}
    for name in PARSED_TEXTS:
        if name in t.names():
            rows, bad = getattr(t, name), is_malformed(name)
            replace_table(rows.where(bad), layers.rejected(name))
            good[name] = rows.where(~bad)
    return t.with_raw(**good)


def run_refresh(
    spark: SparkSession,
    source: Tables,
    layers: Layers,
    detected_at: str | None = None,
    at_once: int = 4,
    quarantine: bool = False,
    readmission: bool = False,
    on_step: Callable[[str], None] | None = None,
    bucketed: tuple[str, int] | None = None,
) -> Refresh:
    """Run all steps; marts only start when staging passed its checks.

    Staging and marts are written as a version of their own, which is published once
    all checks passed. `layers.published` finds it; a failed run leaves the last one.

    With `bucketed`, a catalog database and a number of buckets, the order-keyed raw tables
    are laid out by the order id, and the joins on it need no shuffle.

    Malformed timestamps fail the staging step, or, with `quarantine`, move their
    rows to the error layer. With `readmission`, rows that break any rule of
    `plans.readmission` are logged with their reasons, and mended ones come back.
    """
    layers = layers.new_version()
    done = Refresh(layers)

    def step(name: str) -> None:
        done.steps.append(name)
        if on_step:
            on_step(name)

    if bucketed:
        sync_raw_bucketed(source, layers, *bucketed)
        t = bucketed_tables(spark, layers, bucketed[0], source.names())
    else:
        t = raw_tables(spark, layers, sync_raw(source, layers))
    step("raw_sync")

    fit_shuffles(
        spark, layers.root, lambda: sum(map(input_bytes, t.by_name().values()))
    )
    if quarantine:
        t = set_malformed_aside(t, layers)
    if readmission:
        t = mending.with_admitted(spark, mending.set_aside(t, layers), layers)
    staged = store_staging(spark, t, layers)
    _stop_on_failures(run_checks("stg_orders", staged, STAGING_CHECKS["stg_orders"]))
    step("staging")

    shared = store_shared(spark, t.with_stored(stg_orders=staged), layers).with_unique_orders()
    store_marts(shared, layers, detected_at, at_once)
    step("marts")

    _stop_on_failures(quality_report(spark, staged, layers))
    publish(spark, layers)
    step("checks")
    return done
