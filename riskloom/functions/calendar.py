"""Features of the event time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAYS_PER_YEAR = 365.25
NIGHT_FROM_HOUR = 22
NIGHT_TO_HOUR = 5


def time_parts(time: Column) -> dict[str, Column]:
    """Hour, day of month, month and weekday (Monday is 0)."""
    return {
        "trans_hour": F.hour(time),
        "trans_day": F.dayofmonth(time),
        "trans_month": F.month(time),
        "trans_weekday": F.weekday(time),
    }


def weekend_night(time: Column) -> dict[str, Column]:
    hour = F.hour(time)
    return {
        "is_weekend": (F.weekday(time) >= 5).cast("int"),
        "is_night": ((hour >= NIGHT_FROM_HOUR) | (hour <= NIGHT_TO_HOUR)).cast("int"),
    }


def age_years(birth: Column, reference: Column) -> Column:
    """Whole years from ``birth`` to the reference date, truncated toward zero."""
    return (F.datediff(reference, birth) / F.lit(DAYS_PER_YEAR)).cast("int")
