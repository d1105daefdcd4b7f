"""Stored tables with a key: changes between versions, synchronisation and upserts.

Rows lie in leaves, ranges of the hash of their key. A version of a table is a tree of
digests: a leaf tells rows, two order-free digests and the folder that holds its rows; a
node above tells the sums of its FAN children.

- Two versions are compared from the root down. Below nodes of equal digests nothing is
  read, so that the rows read are those of leaves in which something changed.
- A change writes the rows of the leaves it touches into a folder of the new version; all
  other leaves keep their files. A version can be read once its line in `versions` is
  there, the last thing written, so a run that is cut off leaves the former one.

Nulls are keys like others. Several rows may share a key: versions are compared as bags of
rows, and an upsert replaces all rows of a key by those delivered. One writer at a time: a
version is refused if another has been published since its start. A leaf that a hot key
fills is spread over several tasks and files.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeloom.sources.layers import append_rows

#: Children of a node; a tree of depth d has FAN ** d leaves.
FAN = 16
VERSIONS_DDL = "published_ns bigint, version string, parent string, schema string"
NODES_DDL = "level int, node bigint, n bigint, low decimal(38,0), high decimal(38,0), stored string"
LEAF = "_leaf"


@dataclass(frozen=True)
class KeyedTable:
    """A folder of versions. `depth` 2 gives 256 leaves, 4 gives 65,536."""

    root: str
    key: tuple[str, ...]
    depth: int = 2

    def versions(self) -> str:
        return f"{self.root}/versions"

    def nodes(self, version: str) -> str:
        return f"{self.root}/nodes/{version}"

    def rows(self, version: str) -> str:
        return f"{self.root}/rows/{version}"

    def leaf(self) -> Column:
        return F.pmod(F.xxhash64(*self.key, *_gaps(self.key)), F.lit(FAN**self.depth))


def _gaps(columns) -> list[Column]:
    """Which columns are null: a hash skips nulls, so their places are hashed too."""
    return [F.col(c).isNull() for c in columns]


def _digest(columns, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *columns, *_gaps(columns)).cast("decimal(20,0)")


def last_version(spark: SparkSession, table: KeyedTable) -> str | None:
    """The version published last; None for a table that has none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(table.versions())
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    lines = spark.read.schema(VERSIONS_DDL).parquet(table.versions())
    last = lines.orderBy(F.desc("published_ns"), F.desc("version")).first()
    return last and last["version"]


def _schema(spark: SparkSession, table: KeyedTable, version: str) -> StructType:
    lines = spark.read.schema(VERSIONS_DDL).parquet(table.versions())
    return StructType.fromJson(json.loads(lines.where(F.col("version") == version).first()["schema"]))


def _nodes(spark: SparkSession, table: KeyedTable, version: str | None) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], NODES_DDL)
    return spark.read.schema(NODES_DDL).parquet(table.nodes(version))


def _leaf_digests(rows: DataFrame, table: KeyedTable, stored: str) -> DataFrame:
    """The leaf level of the tree of some rows: one aggregation, reduced where rows are."""
    columns = rows.columns
    marked = rows.select(table.leaf().alias("node"), _digest(columns, 1).alias("low"), _digest(columns, 2).alias("high"))
    found = marked.groupBy("node").agg(F.count("*").alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high"))
    return _as_nodes(found.withColumns({"level": F.lit(table.depth), "stored": F.lit(stored)}))


def _as_nodes(rows: DataFrame) -> DataFrame:
    fields = [field.split() for field in NODES_DDL.replace("38,0", "38;0").split(",")]
    return rows.select(*[F.col(name).cast(kind.replace(";", ",")).alias(name) for name, kind in fields])


def _tree(leaves: DataFrame, depth: int) -> DataFrame:
    """All levels over given leaves: each leaf counts once in a node of every level."""
    levels = F.explode(F.array([F.struct(F.lit(up).alias("up"), F.lit(FAN**up).alias("span")) for up in range(1, depth + 1)]))
    spread = leaves.select("*", levels.alias("at"))
    above = spread.groupBy((F.lit(depth) - F.col("at.up")).alias("level"), F.floor(F.col("node") / F.col("at.span")).alias("node")).agg(
        *[F.sum(c).alias(c) for c in ("n", "low", "high")]
    )
    return leaves.unionByName(_as_nodes(above.withColumn("stored", F.lit(None))))


def differing_leaves(old: DataFrame, new: DataFrame, depth: int) -> list[int]:
    """Numbers of the leaves two trees disagree on, found from the root down.

    Of each level only the children of differing nodes are compared. The list is at most as
    long as the tree has leaves.
    """
    open_nodes = [0]
    for level in range(depth + 1):
        if not open_nodes:
            break
        parents = F.floor(F.col("node") / FAN) if level else F.lit(0)
        here = (F.col("level") == level) & parents.isin(open_nodes)
        sides = [side.where(here).select("node", F.struct("n", "low", "high").alias(name)) for name, side in (("a", old), ("b", new))]
        met = sides[0].join(sides[1], "node", "full")
        open_nodes = [row["node"] for row in met.where(~F.col("a").eqNullSafe(F.col("b"))).select("node").collect()]
    return sorted(open_nodes)


def open_version(spark: SparkSession, table: KeyedTable, version: str | None = None, leaves: list[int] | None = None) -> DataFrame:
    """The rows of a version (default: the last), or of some of its leaves only."""
    version = version or last_version(spark, table)
    if version is None:
        raise ValueError(f"no version of {table.root} has been published")
    schema = _schema(spark, table, version)
    held = _nodes(spark, table, version).where((F.col("level") == table.depth) & (F.col("n") > 0))
    if leaves is not None:
        held = held.where(F.col("node").isin(leaves))
    folders = [f"{table.rows(row['stored'])}/{LEAF}={row['node']}" for row in held.select("stored", "node").collect()]
    return spark.read.schema(schema).parquet(*sorted(folders)) if folders else spark.createDataFrame([], schema)


def _new_version() -> str:
    return f"v{time.time_ns()}-{uuid.uuid4().hex[:8]}"


def _write_rows(rows: DataFrame, table: KeyedTable, version: str) -> None:
    spread = rows.withColumn(LEAF, table.leaf()).hint("rebalance", F.col(LEAF))
    spread.write.partitionBy(LEAF).parquet(table.rows(version))


def _publish(spark: SparkSession, table: KeyedTable, version: str, parent: str | None, leaves: DataFrame, schema: StructType) -> None:
    """Write the tree, then the line that makes the version readable."""
    ordered = _tree(leaves, table.depth).repartition(1).sortWithinPartitions("level", "node")
    ordered.write.parquet(table.nodes(version))
    if last_version(spark, table) != parent:
        raise RuntimeError(f"{table.root} was changed while {version} was made")
    line = spark.createDataFrame([(time.time_ns(), version, parent, schema.json())], VERSIONS_DDL)
    append_rows(line.coalesce(1), table.versions())


def _same_columns(rows: DataFrame, schema: StructType) -> DataFrame:
    if sorted(rows.columns) != sorted(schema.names):
        raise ValueError(f"columns {rows.columns} do not fit {schema.names}")
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def synchronise(rows: DataFrame, table: KeyedTable) -> tuple[str, list[int]]:
    """Make the table hold exactly the rows given; its version and the leaves written.

    The given rows are read once for their digests, and again where leaves differ; of the
    stored ones only digests are read. Nothing is published where nothing differs.
    """
    spark, parent, version = rows.sparkSession, last_version(rows.sparkSession, table), _new_version()
    schema = rows.schema
    if parent is not None:
        schema = _schema(spark, table, parent)
        rows = _same_columns(rows, schema)
    given = _leaf_digests(rows, table, version)
    path = f"{table.nodes(version)}-given"
    _tree(given, table.depth).write.parquet(path)
    given = spark.read.schema(NODES_DDL).parquet(path)
    known = _nodes(spark, table, parent)
    changed = differing_leaves(known, given, table.depth)
    if parent is not None and not changed:
        return parent, []
    _write_rows(rows.where(table.leaf().isin(changed)), table, version)
    touched, at_leaves = F.col("node").isin(changed), F.col("level") == table.depth
    leaves = known.where(at_leaves & ~touched).unionByName(given.where(at_leaves & touched))
    _publish(spark, table, version, parent, leaves, schema)
    return version, changed


def upsert(rows: DataFrame, table: KeyedTable) -> tuple[str, list[int]]:
    """Replace the rows of the keys delivered, add new keys; version and leaves written.

    Only leaves that can hold a delivered key are read and written again. Delivering the
    same rows twice changes nothing.
    """
    spark, parent, version = rows.sparkSession, last_version(rows.sparkSession, table), _new_version()
    if parent is None:
        return synchronise(rows, table)
    schema = _schema(spark, table, parent)
    rows = _same_columns(rows, schema)
    touched = sorted(row[0] for row in rows.select(table.leaf().alias("leaf")).distinct().collect())
    if not touched:
        return parent, []
    kept = open_version(spark, table, parent, touched)
    delivered = rows.select(*table.key).distinct().alias("new")
    same_key = reduce(Column.__and__, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in table.key])
    merged = kept.alias("old").join(delivered, same_key, "left_anti").unionByName(rows)
    _write_rows(merged, table, version)
    written = spark.read.schema(schema).parquet(table.rows(version))
    known = _nodes(spark, table, parent).where((F.col("level") == table.depth) & ~F.col("node").isin(touched))
    leaves = known.unionByName(_leaf_digests(written, table, version))
    _publish(spark, table, version, parent, leaves, schema)
    return version, touched


def changes_between(spark: SparkSession, table: KeyedTable, old: str, new: str) -> DataFrame:
    """The rows two versions hold unequally often: all columns, CHANGE, BEFORE and AFTER.

    CHANGE is `inserted` or `deleted` where only one version has the key, else `changed`;
    BEFORE and AFTER count the row in either version. Rows of equal leaves are not read.
    """
    leaves = differing_leaves(_nodes(spark, table, old), _nodes(spark, table, new), table.depth)
    before, after = open_version(spark, table, old, leaves), open_version(spark, table, new, leaves)
    columns = after.columns
    sides = before.withColumns({"b": F.lit(1), "a": F.lit(0)}).unionByName(after.withColumns({"b": F.lit(0), "a": F.lit(1)}))
    counted = sides.groupBy(*columns).agg(F.sum("b").alias("BEFORE"), F.sum("a").alias("AFTER"))
    keys = sides.groupBy(*table.key).agg(F.max("b").alias("was"), F.max("a").alias("is")).where("was + is = 1")
    kind = F.when(F.col("k.was") == 1, "deleted").when(F.col("k.is") == 1, "inserted").otherwise("changed")
    same_key = reduce(Column.__and__, [F.col(f"r.{k}").eqNullSafe(F.col(f"k.{k}")) for k in table.key])
    moved = counted.where("BEFORE <> AFTER").alias("r")
    return moved.join(keys.alias("k"), same_key, "left").select("r.*", kind.alias("CHANGE")).select(*columns, "CHANGE", "BEFORE", "AFTER")
