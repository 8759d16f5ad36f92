"""Exact arithmetic on money, time and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One amount on one row, and a total over any number of rows. Totals are wide enough that
# a single key holding a third of a very large table cannot overflow.
AMOUNT = "decimal(12,2)"
TOTAL = "decimal(18,2)"
GRAND_TOTAL = "decimal(28,2)"


def hours_between(start: str, end: str) -> Column:
    """Hours from start to end, two decimals, half away from zero; NULL if either is NULL.

    The moments have no zone. Their difference is taken as an interval, which no session
    time zone can bend; timestamp_diff would go through the zone and its clock changes.
    """
    elapsed = (F.col(end) - F.col(start)).cast("interval second").cast("decimal(20,6)")
    return F.round(elapsed / F.lit(3600), 2).cast("decimal(10,2)")


def day_key(moment: str) -> Column:
    """The calendar day as the whole number YYYYMMDD."""
    day = F.col(moment)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_of(key: str) -> Column:
    """The calendar day of a whole number YYYYMMDD."""
    k = F.col(key)
    return F.make_date((k / 10000).cast("int"), (k / 100).cast("int") % 100, k % 100)


def quotient(part: Column, whole: Column, places: int, kind: str, scale: int = 2) -> Column:
    """part / whole with one rounding, at the end.

    Division keeps few places when its operands are declared wide, as sums of sums are, and
    avg() rounds to a few extra places as well; either can turn a value just under a half
    into a half. Both operands are therefore narrowed to what totals need, which leaves the
    quotient at least 16 places.
    """
    exact = part.cast(f"decimal(22,{scale})") / whole.cast("decimal(20,2)")
    return F.round(exact, places).cast(kind)


def rows() -> Column:
    return F.count(F.lit(1))


def ratio(part: Column, whole: Column, places: int = 6) -> Column:
    """part / whole of two counts as a rounded decimal; NULL when whole is 0."""
    return quotient(part, F.nullif(whole, F.lit(0)), places, f"decimal({places + 3},{places})")
