"""Calendar and clock features as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhawk.schema import TIME

DAYS_PER_AGE_YEAR = 365


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, for frames over exact time distances."""
    return F.unix_micros(ts.cast("timestamp"))


def age_years(ts: Column, dob: Column) -> Column:
    """Completed years of 365 days between a birth date and a moment."""
    return F.floor(F.datediff(ts, dob) / DAYS_PER_AGE_YEAR).cast("int")


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts).isin(5, 6).cast("int")


def hour_within(hour: Column, start: int, end: int) -> Column:
    """1 when the hour lies in [start, end) on a clock that wraps at midnight."""
    if start < end:
        inside = (hour >= start) & (hour < end)
    else:
        inside = (hour >= start) | (hour < end)
    return inside.cast("int")


def circular_hours(a: Column, b: Column) -> Column:
    """Shortest distance between two hours of the day."""
    gap = F.abs(a - b)
    return F.when(gap > 24 - gap, 24 - gap).otherwise(gap)


def hour_minute(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def year_gap(ts: Column, dob: Column) -> Column:
    return F.year(ts) - F.year(dob)


def add_temporal_features(df: DataFrame) -> DataFrame:
    ts = F.col(TIME)
    return df.withColumns(
        {
            "customer_age": age_years(ts, F.col("dob")),
            "trans_hour": F.hour(ts),
            "trans_day_of_week": F.weekday(ts),
            "trans_month": F.month(ts),
            "is_weekend": is_weekend(ts),
        }
    )
