"""Storage layers as Parquet folders below one root, and the write modes."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.schemas import RAW_DDL, TEXT_LIMITS, raw_schema
from tradeloom.sources.tables import Tables

# Tables joined on the order id in most models.
ORDER_KEYED = ("orders", "order_items", "order_payments", "order_reviews")

# Column defaults of the extended customer table.
EXTENDED_DEFAULTS = {"is_synthetic": "true", "data_source": "'synthetic_2019'"}


@dataclass(frozen=True)
class Layers:
    """Folder layout: raw tables, staging, marts, and rejected rows.

    Staging and marts lie below a version, if there is one: a refresh builds a version
    of its own and publishes it at its end, so readers only see finished ones.
    """

    root: str
    version: str = ""

    def _versioned(self, layer: str, name: str) -> str:
        return "/".join(x for x in (self.root, layer, self.version, name) if x)

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def staging(self, name: str) -> str:
        return self._versioned("stg", name)

    def mart(self, name: str) -> str:
        return self._versioned("mrt", name)

    def rejected(self, name: str) -> str:
        return f"{self.root}/err/{name}"

    def versions(self) -> str:
        return f"{self.root}/versions"

    def new_version(self) -> Layers:
        return replace(self, version=f"v{time.time_ns()}-{uuid.uuid4().hex[:8]}")


VERSION_DDL = "published_ns long, version string"


def publish(spark: SparkSession, layers: Layers) -> None:
    """Make a version the one that `published` finds: one appended row, one file."""
    row = spark.createDataFrame([(time.time_ns(), layers.version)], VERSION_DDL)
    append_rows(row.coalesce(1), layers.versions())


def published(spark: SparkSession, layers: Layers) -> Layers:
    """The layers at the version published last; without one an error of the reader."""
    rows = spark.read.schema(VERSION_DDL).parquet(layers.versions())
    last = rows.orderBy(F.desc("published_ns"), F.desc("version")).first()
    return replace(layers, version=last["version"])


def replace_table(df: DataFrame, path: str) -> None:
    """Full refresh of a stored table."""
    df.write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a stored table."""
    df.write.mode("append").parquet(path)


def replace_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Full refresh of a catalog table laid out by a key.

    Tables bucketed alike on a key join on it without a shuffle. Only for keys
    without hot values, since a bucket cannot be split. Needs a catalog that keeps
    bucket metadata for the sessions that read the table.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )


def open_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The declared columns of a stored raw table; all of one without a declaration."""
    if name not in RAW_DDL:
        return spark.read.parquet(path)
    return spark.read.schema(raw_schema(name)).parquet(path)


def sync_raw(source: Tables, layers: Layers) -> list[str]:
    """Copy every source table, whole, to the raw layer, replacing what is there."""
    for name in source.names():
        replace_table(getattr(source, name), layers.raw(name))
    return source.names()


def sync_raw_bucketed(
    source: Tables, layers: Layers, database: str, buckets: int
) -> None:
    """As `sync_raw`, with the order-keyed tables bucketed on the order id."""
    for name in source.names():
        frame, path = getattr(source, name), layers.raw(name)
        if name in ORDER_KEYED:
            replace_bucketed(frame, f"{database}.{name}", path, "order_id", buckets)
        else:
            replace_table(frame, path)


def raw_tables(spark: SparkSession, layers: Layers, names: list[str] | None = None) -> Tables:
    """The raw layer as model input."""
    return Tables(
        {
            name: partial(open_table, spark, layers.raw(name), name)
            for name in names or RAW_DDL
        }
    )


def bucketed_tables(
    spark: SparkSession, layers: Layers, database: str, names: list[str] | None = None
) -> Tables:
    """The raw layer with the order-keyed tables taken from the catalog."""
    return Tables(
        {
            name: partial(spark.table, f"{database}.{name}")
            if name in ORDER_KEYED
            else partial(open_table, spark, layers.raw(name), name)
            for name in names or RAW_DDL
        }
    )


def register_sources(spark: SparkSession, source: Tables) -> list[str]:
    """Expose every source table under the view name `raw_<table>`."""
    views = []
    for name, frame in source.by_name().items():
        frame.createOrReplaceTempView(f"raw_{name}")
        views.append(f"raw_{name}")
    return views


def create_extended_customers(spark: SparkSession, table: str, path: str) -> None:
    """Create the extended customer table unless it exists.

    Text lengths are enforced on write, missing columns take their defaults. The
    primary key is a `not_null` and a `unique` check, as Parquet has no keys.
    """
    columns = []
    for column in raw_schema("customers_extended").fields:
        limit = TEXT_LIMITS.get(column.name)
        kind = f"varchar({limit})" if limit else column.dataType.simpleString()
        default = EXTENDED_DEFAULTS.get(column.name)
        columns.append(f"{column.name} {kind}" + (f" default {default}" if default else ""))
    listed = ", ".join(columns)
    spark.sql(
        f"create table if not exists {table} ({listed}) using parquet location '{path}'"
    )


