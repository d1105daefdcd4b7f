"""Sums that do not depend on the order of summation.

A double is split into its whole part and its rest in millionths, both whole numbers. Their
sums are exact whatever the order, so a total is the same bit by bit however the rows are
dealt to tasks. More than six digits behind the point are rounded per value.

Nulls are left out; without values a sum is null. Whole parts add up to 9e18 and rests of
9e12 values fit; beyond, and for a value that is not finite, the query fails instead of
telling a wrong total (under ANSI arithmetic, which is Spark's default).
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

#: Parts of a whole that are told apart.
UNITS = 1_000_000


def whole_part(value: Column) -> Column:
    """The largest whole number that is not above the value."""
    return F.floor(value.cast("double")).cast("bigint")


def rest_part(value: Column) -> Column:
    """What is above the whole part, in millionths."""
    number = value.cast("double")
    return F.round((number - F.floor(number)) * UNITS).cast("bigint")


def joined(whole: Column, rest: Column) -> Column:
    """Sums of both parts as an exact decimal."""
    return whole.cast("decimal(20,0)") + rest.cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(6,6)")


def exact_decimal(value: Column, over: WindowSpec | None = None) -> Column:
    """The sum of a column as a decimal with six digits behind the point."""
    parts = [F.sum(part(value)) for part in (whole_part, rest_part)]
    return joined(*[part if over is None else part.over(over) for part in parts])


def exact_sum(value: Column, over: WindowSpec | None = None) -> Column:
    """The same as the nearest double."""
    return exact_decimal(value, over).cast("double")


def total_over(value: Column, *part: str) -> Column:
    """The sum over all rows, or over those of one part, on every row."""
    return exact_sum(value, Window.partitionBy(*[F.col(p) for p in part]))
