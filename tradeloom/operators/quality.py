"""Data-quality checks: declared per model, run as aggregations, one report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

REPORT_COLUMNS = ["MODEL", "CHECK_NAME", "COLUMN_NAME", "FAILURES"]


class ContractError(ValueError):
    """A model's columns or types differ from its declared contract."""


@dataclass(frozen=True)
class Checks:
    """Checks declared for one model."""

    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Mapping[str, Sequence] = field(default_factory=dict)

    def count(self) -> int:
        return len(self.not_null) + len(self.unique) + len(self.accepted)


def _report(counts: DataFrame, labels: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Turn one row of counts into one row per check."""
    rows = F.array(
        *[
            F.struct(
                F.lit(check).alias("CHECK_NAME"),
                F.lit(column).alias("COLUMN_NAME"),
                F.col(count).alias("FAILURES"),
            )
            for count, (check, column) in labels.items()
        ]
    )
    return counts.select(F.inline(rows))


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null rows per column; all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"f{i}") for i, c in enumerate(columns)])
    return _report(counts, {f"f{i}": ("not_null", c) for i, c in enumerate(columns)})


def unique(df: DataFrame, column: str) -> DataFrame:
    """How many non-null values occur more than once."""
    repeated = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.count_if(F.col("copies") > 1).alias("f0"))
    )
    return _report(repeated, {"f0": ("unique", column)})


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """How many distinct non-null values lie outside the list."""
    outside = df.where(~F.col(column).isin(list(values))).agg(
        F.count_distinct(column).alias("f0")
    )
    return _report(outside, {"f0": ("accepted_values", column)})


def text_limits(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Values longer than their declared text length; all columns in one pass."""
    counts = df.agg(
        *[F.count_if(F.length(c) > n).alias(f"f{i}") for i, (c, n) in enumerate(limits.items())]
    )
    return _report(counts, {f"f{i}": ("text_limit", c) for i, c in enumerate(limits)})


def run_checks(model: str, df: DataFrame, checks: Checks) -> DataFrame:
    """All checks of one model as report rows."""
    parts = [not_null(df, checks.not_null)] if checks.not_null else []
    parts += [unique(df, column) for column in checks.unique]
    parts += [accepted_values(df, c, values) for c, values in checks.accepted.items()]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select(F.lit(model).alias("MODEL"), *REPORT_COLUMNS[1:])


def suite(frames: Mapping[str, DataFrame], declared: Mapping[str, Checks]) -> DataFrame:
    """Report over all models; zero failures everywhere means the suite passed."""
    return reduce(
        DataFrame.unionByName,
        [run_checks(name, frames[name], checks) for name, checks in declared.items()],
    )


def contract_differences(df: DataFrame, declared: StructType) -> list[str]:
    """Columns whose name, position or type differs from the declaration."""
    actual = [f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields]
    wanted = [f"{f.name} {f.dataType.simpleString()}" for f in declared.fields]
    size = max(len(actual), len(wanted))
    actual += ["(missing)"] * (size - len(actual))
    wanted += ["(undeclared)"] * (size - len(wanted))
    return [f"{a} instead of {w}" for a, w in zip(actual, wanted) if a != w]


def enforce_contract(model: str, df: DataFrame, declared: StructType) -> DataFrame:
    """Return the frame, or raise when it does not match its contract."""
    differences = contract_differences(df, declared)
    if differences:
        raise ContractError(f"{model}: " + "; ".join(differences))
    return df
