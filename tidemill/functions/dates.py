"""Date and time expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Meal bands as (label, first second, last second), both ends included.
MEAL_BANDS = [("Breakfast", 8 * 3600, 12 * 3600), ("Lunch", 12 * 3600 + 1, 16 * 3600),
              ("Dinner", 16 * 3600 + 1, 20 * 3600)]


def seconds_of_day(c: Column) -> Column:
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def time_band(c: Column, bands: Sequence[tuple[str, int, int]] = tuple(MEAL_BANDS), default: str = "Error") -> Column:
    """Label of the time-of-day band holding the timestamp."""
    sec, label = seconds_of_day(c), F.lit(default)
    for name, low, high in reversed(bands):
        label = F.when(sec.between(low, high), F.lit(name)).otherwise(label)
    return label


def repair_date(c: Column) -> Column:
    """``dd-mm-YYYY`` and ``YYYY-dd-mm`` (recognised by a middle part above 12) to ``YYYY-mm-dd``.

    NULL stays NULL, and text that has not three parts stays as it is.
    """
    first, month_part, last = (F.get(F.split(c, "-"), i) for i in range(3))
    year_last = F.length(first) == 2
    year = F.when(year_last, last).otherwise(first)
    day_part = F.when(year_last, first).otherwise(last)
    swapped = F.try_to_number(month_part, F.lit("99")) > 12
    month = F.when(swapped, day_part).otherwise(month_part)
    day = F.when(swapped, month_part).otherwise(day_part)
    return F.when(F.size(F.split(c, "-")) == 3, F.concat_ws("-", year, month, day)).otherwise(c)


def quarter_label(c: Column) -> Column:
    """``2019Q1``."""
    return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))


def is_weekend(c: Column) -> Column:
    """Monday is 0; Saturday and Sunday are the weekend."""
    return F.weekday(c) > 4


def stay_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def whole_days(seconds: Column) -> Column:
    return F.floor(seconds / 86400).cast("bigint")


def rest_hours(seconds: Column, digits: int = 1) -> Column:
    return F.round((seconds % 86400) / 3600.0, digits)


def clock_seconds(c: Column) -> Column:
    """``HH:MM:SS`` text to seconds of day; NULL when malformed or past 23 hours."""
    parts = F.split(c, ":")
    hour = F.try_to_number(F.get(parts, F.lit(0)), F.lit("99")).cast("int")
    rest = F.try_to_number(F.get(parts, F.lit(1)), F.lit("99")).cast("int") * 60 + \
        F.try_to_number(F.get(parts, F.lit(2)), F.lit("99")).cast("int")
    return F.when(hour <= 23, hour * 3600 + rest)
