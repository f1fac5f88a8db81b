"""Calendar parts and cyclic encodings of a timestamp column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Peak hours and day parts, first and last hour inclusive.
PEAK_HOURS = ((7, 9), (16, 18))
DAY_PARTS = (("Morning", 5, 11), ("Afternoon", 12, 16), ("Evening", 17, 20))
OTHER_DAY_PART = "Night"

CALENDAR_COLUMNS = (
    "date", "hour", "minute", "day_of_week", "day_of_month", "week_of_year", "month",
    "is_weekend", "is_peak_hour", "time_of_day",
)
CYCLIC_COLUMNS = ("hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos")


def calendar_parts(time: str) -> dict[str, Column]:
    hour, weekday = F.hour(time), F.dayofweek(time)
    (first, last), *more_peaks = PEAK_HOURS
    peak = hour.between(first, last)
    for first, last in more_peaks:
        peak = peak | hour.between(first, last)
    (name, first, last), *more_parts = DAY_PARTS
    day_part = F.when(hour.between(first, last), name)
    for name, first, last in more_parts:
        day_part = day_part.when(hour.between(first, last), name)
    return {
        "date": F.to_date(time),
        "hour": hour,
        "minute": F.minute(time),
        "day_of_week": weekday,
        "day_of_month": F.dayofmonth(time),
        "week_of_year": F.weekofyear(time),
        "month": F.month(time),
        "is_weekend": weekday.isin(1, 7).cast("int"),
        "is_peak_hour": peak.cast("int"),
        "time_of_day": day_part.otherwise(OTHER_DAY_PART),
    }


def cyclic_parts(time: str) -> dict[str, Column]:
    cycles = {
        "hour": (F.hour(time), 24),
        "day": (F.dayofweek(time) - 1, 7),
        "month": (F.month(time) - 1, 12),
    }
    parts = {}
    for name, (position, period) in cycles.items():
        angle = 2 * F.pi() * position / period
        parts[f"{name}_sin"] = F.sin(angle)
        parts[f"{name}_cos"] = F.cos(angle)
    return parts


def calendar_columns(df: DataFrame, time: str = "timestamp") -> DataFrame:
    return df.withColumns(calendar_parts(time))


def cyclic_columns(df: DataFrame, time: str = "timestamp") -> DataFrame:
    return df.withColumns(cyclic_parts(time))
