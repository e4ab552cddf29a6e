"""Hour arithmetic that stays in TIMESTAMP_NTZ.

`date_trunc` turns an NTZ value into a zoned TIMESTAMP, so hours are rebuilt from the
date and the hour number instead; no step depends on the session time zone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR = "TimestampHour"
KEY = "SettlementPoint"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hours(n: Column | int) -> Column:
    """Day-time interval of `n` hours."""
    return F.make_dt_interval(F.lit(0), F.lit(n) if isinstance(n, int) else n)


def floor_day(ts: Column | str) -> Column:
    return _col(ts).cast("date").cast("timestamp_ntz")


def floor_hour(ts: Column | str) -> Column:
    ts = _col(ts)
    return floor_day(ts) + hours(F.hour(ts))


def hour_ending(value: Column | str, strict: bool = True) -> Column:
    """1..24 from `7`, `7.0`, `"7"` or `"07:00"`; null stays null.

    Strict mode raises on junk; otherwise junk becomes null (see `reject_hour_ending`).
    """
    text = F.trim(_col(value).cast("string"))
    head = F.split_part(text, F.lit(":"), F.lit(1))
    as_double = head.cast("double") if strict else head.try_cast("double")
    return as_double.cast("int")


def reject_hour_ending(df: DataFrame, column: str = "HourEnding") -> DataFrame:
    """Rows whose hour label is present but unreadable."""
    return df.filter(F.col(column).isNotNull() & hour_ending(column, strict=False).isNull())


def operday_to_hour(df: DataFrame, day: str = "OperDay", label: str = "HourEnding", strict: bool = True) -> DataFrame:
    """Add the hour start for a date and an hour-ending label. Null labels give a null hour."""
    return df.withColumn(HOUR, F.col(day).cast("timestamp_ntz") + hours(hour_ending(label, strict) - 1))


def deliverydate_to_hour(
    df: DataFrame, day: str = "DeliveryDate", label: str = "HourEnding", strict: bool = True
) -> DataFrame:
    """As `operday_to_hour`, but the day may carry a time part and unlabelled rows are dropped."""
    number = hour_ending(label, strict)
    return df.withColumn(HOUR, floor_day(day) + hours(number - 1)).filter(F.col(HOUR).isNotNull())


def interval_to_hour(df: DataFrame, ts: str) -> DataFrame:
    """Add the hour a sub-hourly timestamp falls into."""
    return df.withColumn(HOUR, floor_hour(ts))


def calendar_features(df: DataFrame, ts: str = HOUR) -> DataFrame:
    """Hour, DayOfWeek (Monday 0), Month, Quarter, IsWeekend."""
    dow = F.weekday(ts)
    return df.withColumns(
        {
            "Hour": F.hour(ts),
            "DayOfWeek": dow,
            "Month": F.month(ts),
            "Quarter": F.quarter(ts),
            "IsWeekend": (dow >= 5).cast("int"),
        }
    )


def cyclic_features(df: DataFrame, ts: str = HOUR) -> DataFrame:
    """Sine and cosine of the hour in its day and the month in its year."""
    day_angle = F.lit(2 * math.pi) * F.hour(ts) / 24
    year_angle = F.lit(2 * math.pi) * F.month(ts) / 12
    return df.withColumns(
        {
            "hour_sin": F.sin(day_angle),
            "hour_cos": F.cos(day_angle),
            "month_sin": F.sin(year_angle),
            "month_cos": F.cos(year_angle),
        }
    )


def time_index(df: DataFrame, train: DataFrame, ts: str = HOUR) -> DataFrame:
    """Whole hours since the first hour of `train`; the start is one scalar subquery."""
    start = train.agg(F.min(ts).alias("start")).scalar()
    return df.withColumn("time_idx", F.timestamp_diff("HOUR", start, F.col(ts)))
