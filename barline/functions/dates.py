"""Trading dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_date(epoch_ms: Column) -> Column:
    """The UTC date of a millisecond timestamp (the session is pinned to UTC).

    Null outside the years 1 to 9999, which is what a date may be.
    """
    whole = F.when(in_calendar(epoch_ms), epoch_ms).cast("bigint")
    return F.to_date(F.timestamp_millis(whole))


# Milliseconds of the first instant of year 1 and of year 10000.
FIRST_MS, END_MS = -62_135_596_800_000, 253_402_300_800_000


def in_calendar(epoch_ms: Column) -> Column:
    return (epoch_ms >= FIRST_MS) & (epoch_ms < END_MS)


def is_weekday(date: Column) -> Column:
    return F.weekday(date) < 5


def weekdays(start: Column, end: Column) -> Column:
    """Every weekday from ``start`` to ``end``, both ends included, as an array."""
    return F.filter(F.sequence(start, end, F.expr("interval 1 day")), is_weekday)


def target_date(run_date: Column, previous_weekday: bool = False) -> Column:
    """The day a run loads: the calendar day before it, so Monday loads Sunday.

    ``previous_weekday`` moves a weekend target back to the Friday before.
    """
    before = F.date_sub(run_date, 1)
    if not previous_weekday:
        return before
    return F.date_sub(before, F.greatest(F.weekday(before) - 4, F.lit(0)))


def days_to_expiration(expiration: Column, trade_date: Column) -> Column:
    """Whole days left, negative once the contract has expired."""
    return F.datediff(expiration, trade_date)
