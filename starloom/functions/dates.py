"""Dates, epochs and calendar parts, all as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(column: Column) -> Column:
    """Date or timestamp → integer ``yyyymmdd``."""
    return (F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)).cast("int")


def epoch_ms_to_timestamp(column: Column, whole_seconds: bool = True) -> Column:
    """Epoch milliseconds → timestamp, cut to whole seconds or with the fraction."""
    millis = column.cast("bigint")
    if whole_seconds:
        return F.timestamp_seconds(F.floor(millis / F.lit(1000)).cast("bigint"))
    return F.timestamp_millis(millis)


def timestamp_to_epoch_ms(column: Column) -> Column:
    return F.unix_millis(column.cast("timestamp"))


def calendar_parts(column: Column, weekday_base: int = 0) -> dict[str, Column]:
    """hour, day, week (ISO), month, year and weekday; ``weekday_base`` is Sunday's number."""
    return {
        "hour": F.hour(column),
        "day": F.dayofmonth(column),
        "week": F.weekofyear(column),
        "month": F.month(column),
        "year": F.year(column),
        "weekday": F.dayofweek(column) - 1 + weekday_base,
    }
