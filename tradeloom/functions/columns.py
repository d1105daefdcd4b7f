"""Column helpers shared by every model.

They pin the points where engines differ: rounding, weekday numbers, calendar
day differences, and truncation of zone-less timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order statuses, payment types and labels that results carry.
DELIVERED = "delivered"
CANCELED = "canceled"
CREDIT_CARD = "credit_card"
UNKNOWN_CATEGORY = "unknown"


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero, as a double.

    The detour over decimal(28,8) removes binary noise first, so 1.005 becomes 1.01.
    Sums come from `functions.money`, so they don't depend on the order of rows.
    """
    return F.round(value.cast("decimal(28,8)"), digits).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, null when the denominator is zero or null."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """`part` in percent of `whole`, two digits, null for an empty whole."""
    return half_up(ratio(part.cast("double") * 100.0, whole), 2)


def days_between(start: Column, end: Column) -> Column:
    """Calendar days crossed from `start` to `end` (23:00 to 01:00 is one day)."""
    return F.datediff(end, start)


def weekday_number(moment: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(moment) - F.lit(1)


def day_start(moment: Column) -> Column:
    """Midnight of the day. Goes over date, so no session zone is involved."""
    return moment.cast("date").cast("timestamp_ntz")


def month_start(moment: Column) -> Column:
    """Midnight of the first day of the month."""
    return F.trunc(moment.cast("date"), "month").cast("timestamp_ntz")


def hour_start(moment: Column) -> Column:
    """The full hour at or before the moment."""
    return F.timestamp_add("HOUR", F.hour(moment), day_start(moment))


def category_label(english: Column, raw: Column) -> Column:
    """English category, else the raw one, else the fixed fallback."""
    return F.coalesce(english, raw, F.lit(UNKNOWN_CATEGORY))


def is_late() -> Column:
    """Delivered after the promised moment (columns of the short orders view)."""
    return F.col("delivered_at") > F.col("estimated_at")


def descending(name: str) -> Column:
    """Descending with nulls first, the order the ranked reports are defined in."""
    return F.col(name).desc_nulls_first()


def ascending(name: str) -> Column:
    """Ascending with nulls last."""
    return F.col(name).asc_nulls_last()
