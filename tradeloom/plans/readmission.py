"""Rows that fail a declared check: kept with their reasons, mended, and let in once.

`set_aside` appends the refused rows of a refresh to a log, one folder per version, with the
reasons and a digest of the row as it came. `replay` mends what is open, holds it against the
same rules and stores what passes, with its digest; rows that still fail stay open. A replay
counts once its line is published, so one that is cut off leaves nothing and can be repeated;
only one may run at a time. `with_admitted` adds the mended rows to those that were good.

- A row is open if its digest is in the log and in no published replay. A refresh that copies
  a source whole logs the same rows again: those of the last version that holds them count.
- Rows that are equal in all columns share a digest, and are mended and let in together.
- All rows of a repeated key are refused: none of them can be preferred.
- A source that mends its row itself wins: a mended row whose key is among the good ones, or
  one that an earlier replay let in, stays out.
- A row with a null key is refused where the key must not be null; elsewhere it is let in.
- Joins on digests and keys of refused rows are shuffled: Spark takes a column of digests for
  a small share of its file, and would send lists that grow with the input to the driver.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeloom.operators.lookups import lookup_join
from tradeloom.operators.staging import PARSED_TEXTS
from tradeloom.plans.catalog import ORDER_STATUSES
from tradeloom.schemas import raw_schema
from tradeloom.sources.layers import Layers, append_rows, replace_table
from tradeloom.sources.tables import Tables


@dataclass(frozen=True)
class Rules:
    """What the rows of a raw table have to satisfy, and their key."""

    key: str
    unique: bool = False
    readable: Sequence[str] = ()
    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)


RULES = {
    "orders": Rules(
        key="order_id",
        unique=True,
        readable=PARSED_TEXTS["orders"],
        not_null=["order_id", "customer_id"],
        accepted={"order_status": ORDER_STATUSES},
    ),
    "order_reviews": Rules(key="review_id", readable=PARSED_TEXTS["order_reviews"]),
}

LOG_DDL = "REASONS array<string>, DIGEST string"
REPLAYS_DDL = "published_ns long, REPLAY string"

Mend = Callable[[DataFrame], DataFrame]


def _log(layers: Layers, name: str) -> str:
    return f"{layers.root}/err_log/{name}"


def _admitted(layers: Layers, name: str) -> str:
    return f"{layers.root}/err_back/{name}"


def _replays(layers: Layers, name: str) -> str:
    return f"{layers.root}/err_replays/{name}"


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _opened(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table; an empty one before the first write."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def with_reasons(rows: DataFrame, rules: Rules) -> DataFrame:
    """The rows and REASONS, the rules that each of them breaks."""
    broken = {f"null {c}": F.col(c).isNull() for c in rules.not_null}
    broken |= {f"unreadable {c}": F.col(c).isNotNull() & F.col(c).try_cast("timestamp_ntz").isNull() for c in rules.readable}
    broken |= {f"unaccepted {c}": ~F.col(c).isin(list(values)) for c, values in rules.accepted.items()}
    if rules.unique:
        known = rows.where(F.col(rules.key).isNotNull()).groupBy(rules.key).agg(F.count(F.lit(1)).alias("ROWS_OF_KEY"))
        again = known.where(F.col("ROWS_OF_KEY") > 1)
        rows = lookup_join(rows, again, rules.key, "left", derived=True)
        broken[f"repeated {rules.key}"] = F.col("ROWS_OF_KEY").isNotNull()
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(text)) for text, bad in broken.items()]))
    return rows.withColumn("REASONS", reasons).drop("ROWS_OF_KEY")


def set_aside(t: Tables, layers: Layers) -> Tables:
    """The good rows of every table with rules; the others go to the log of this version.

    Run again for the same version, it replaces what that version has logged.
    """
    good = {}
    for name, rules in RULES.items():
        if name in t.names():
            declared = raw_schema(name).names
            told = with_reasons(getattr(t, name), rules)
            bad = told.where(F.size("REASONS") > 0)
            digest = F.sha2(F.to_json(F.struct(*declared)), 256)
            replace_table(bad.select(*declared, "REASONS", digest.alias("DIGEST")), f"{_log(layers, name)}/VERSION={layers.version}")
            good[name] = told.where(F.size("REASONS") == 0).drop("REASONS")
    return t.with_raw(**good)


def admitted_rows(spark: SparkSession, layers: Layers, name: str) -> DataFrame:
    """The mended rows of all published replays, with the digests they had before."""
    schema = StructType([*raw_schema(name).fields, *StructType.fromDDL("DIGEST string, REPLAY string").fields])
    published = _opened(spark, _replays(layers, name), StructType.fromDDL(REPLAYS_DDL)).select("REPLAY")
    return _opened(spark, _admitted(layers, name), schema).join(published, "REPLAY", "left_semi")


def open_rows(spark: SparkSession, layers: Layers, name: str) -> DataFrame:
    """Refused rows that no replay has let in, with REASONS, DIGEST and VERSION."""
    schema = StructType([*raw_schema(name).fields, *StructType.fromDDL(f"{LOG_DDL}, VERSION string").fields])
    logged = _opened(spark, _log(layers, name), schema)
    last = logged.groupBy("DIGEST").agg(F.max("VERSION").alias("VERSION"))
    back = admitted_rows(spark, layers, name).select("DIGEST").distinct()
    return logged.join(last.hint("merge"), ["DIGEST", "VERSION"], "left_semi").join(back.hint("merge"), "DIGEST", "left_anti")


def replay(spark: SparkSession, layers: Layers, name: str, mend: Mend) -> None:
    """Mend the open rows and let in those that pass.

    `mend` gets the declared columns and DIGEST, and returns them; it may leave rows out.
    """
    rules, declared = RULES[name], raw_schema(name).names
    mended = mend(open_rows(spark, layers, name).select(*declared, "DIGEST"))
    passed = with_reasons(mended, rules).where(F.size("REASONS") == 0)
    if rules.unique:
        passed = passed.join(admitted_rows(spark, layers, name).select(rules.key).hint("merge"), rules.key, "left_anti")
    mark = f"r{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    replace_table(passed.select(*declared, "DIGEST"), f"{_admitted(layers, name)}/REPLAY={mark}")
    line = spark.createDataFrame([(time.time_ns(), mark)], REPLAYS_DDL)
    append_rows(line.coalesce(1), _replays(layers, name))


def with_admitted(spark: SparkSession, t: Tables, layers: Layers) -> Tables:
    """The tables with the mended rows whose key is not among the good ones."""
    whole = {}
    for name, rules in RULES.items():
        if name in t.names():
            good, declared = getattr(t, name), raw_schema(name).names
            back = admitted_rows(spark, layers, name).select(*declared)
            new = back.join(good.select(rules.key).distinct().hint("merge"), rules.key, "left_anti").select(*declared)
            whole[name] = good.unionByName(new, allowMissingColumns=True)
    return t.with_raw(**whole)
