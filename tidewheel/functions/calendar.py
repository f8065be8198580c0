"""Calendar features; everything is an expression on the timestamp, so no join is needed."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def hour_floor(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def day_floor(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def month_floor(ts: Column) -> Column:
    return F.date_trunc("month", ts).cast("timestamp_ntz")


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def cyclic_time(ts: Column) -> dict[str, Column]:
    """Six columns: time of day, day of week, month of year."""
    clock = F.hour(ts) + F.minute(ts) / F.lit(60.0)
    parts = {"start_hour": (clock, 24), "weekday": (F.weekday(ts), 7), "month": (F.month(ts) - 1, 12)}
    out = {}
    for name, (value, period) in parts.items():
        out[f"{name}_sin"], out[f"{name}_cos"] = cyclic(value, period)
    return out


def _observed(ts: Column, month: int, day: int) -> Column:
    """A fixed date moved to the nearest working day, as a test on the observed day itself."""
    wd = F.weekday(ts)

    def falls(offset: int, on: Column) -> Column:
        moved = F.date_add(ts.cast("date"), -offset)
        return (F.month(moved) == month) & (F.dayofmonth(moved) == day) & on

    # same day on a working day; Saturday is observed the Friday before, Sunday the Monday after
    return falls(0, wd < 5) | falls(-1, wd == 4) | falls(1, wd == 0)


def _nth(ts: Column, month: int, wd: int, first_day: int, last_day: int) -> Column:
    return (F.month(ts) == month) & (F.weekday(ts) == wd) & F.dayofmonth(ts).between(first_day, last_day)


# Month and day of the fixed-date federal holidays (Juneteenth counts from 2021).
FIXED_HOLIDAYS = {"new_year": (1, 1), "independence": (7, 4), "veterans": (11, 11), "christmas": (12, 25)}
JUNETEENTH = (6, 19)
JUNETEENTH_FROM = 2021
# Month, weekday (Monday 0), first and last possible day of the floating holidays.
FLOATING_HOLIDAYS = {
    "king": (1, 0, 15, 21),
    "washington": (2, 0, 15, 21),
    "memorial": (5, 0, 25, 31),
    "labor": (9, 0, 1, 7),
    "columbus": (10, 0, 8, 14),
    "thanksgiving": (11, 3, 22, 28),
}


def is_federal_holiday(ts: Column) -> Column:
    """1 on the observed day of a United States federal holiday, tested on whole days."""
    test = _observed(ts, *JUNETEENTH) & (F.year(ts) >= JUNETEENTH_FROM)
    for month, day in FIXED_HOLIDAYS.values():
        test = test | _observed(ts, month, day)
    for rule in FLOATING_HOLIDAYS.values():
        test = test | _nth(ts, *rule)
    return F.coalesce(test, F.lit(False)).cast("int")


def is_special_day(ts: Column) -> Column:
    """Holidays, the day after Thanksgiving, and 24 December to 1 January."""
    after_thanksgiving = _nth(ts, 11, 4, 23, 29)
    year_end = ((F.month(ts) == 12) & (F.dayofmonth(ts) >= 24)) | ((F.month(ts) == 1) & (F.dayofmonth(ts) == 1))
    return ((is_federal_holiday(ts) == 1) | after_thanksgiving | year_end).cast("int")


def slot(ts: Column) -> Column:
    """Hour of the day, weekend hours after the 24 working-day hours."""
    return F.hour(ts) + F.lit(24) * is_weekend(ts)


def iso_week_group(ts: Column) -> Column:
    """ISO year * 100 + ISO week; hours of one week always share the group."""
    return F.extract(F.lit("YEAROFWEEK"), ts) * 100 + F.weekofyear(ts)


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")
