"""City tables kept up to date batch by batch: only days (months, years) with new rows are rebuilt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import date_key
from starloom.operators.rollup import RollUp, merge_batch
from starloom.plans import city


def _period(unit: str) -> Column:
    """The folder of a group: its day, month or year as a number."""
    parts = {"day": 1, "month": 100, "year": 10_000}
    if unit not in parts:
        raise ValueError(f"unknown period {unit!r}, use one of {list(parts)}")
    return F.floor(F.col("date_key") / parts[unit]).cast("int")


def trip_rollup(unit: str = "day") -> RollUp:
    return RollUp(
        ["vendor_key", "pickup_location_key", "drop_off_location_key", "date_key"],
        _period(unit),
        {
            "passenger_count": F.col("passenger_count"),
            "total_payment_amount": F.col("total_payment_amount"),
            "trip_count": F.lit(1),
        },
    )


def crash_rollup(unit: str = "day") -> RollUp:
    return RollUp(
        ["date_key", "location_key"], _period(unit), city.crash_measures(), {name: name for name in city.CRASH_LISTS}
    )


def merge_trips(raw: DataFrame, root: str, batch: int, unit: str = "day") -> list:
    """Add a batch of raw trip rows to the trip fact under ``root``; returns the periods rebuilt."""
    trips = city.clean_trips(raw).withColumn("date_key", date_key(F.col("trip_date")))
    return merge_batch(trip_rollup(unit), trips, root, batch)


def merge_crashes(raw: DataFrame, polygons: DataFrame, root: str, batch: int, unit: str = "day") -> list:
    """Locate a batch of raw crash rows and add it to the crash dimension under ``root``."""
    located = city.locate_crashes(city.clean_crashes(raw), polygons)
    return merge_batch(crash_rollup(unit), city.keyed_crashes(located), root, batch)


def trip_table(spark: SparkSession, root: str) -> DataFrame:
    stored = spark.read.parquet(f"{root}/table")
    return stored.withColumn("total_payment_amount", F.col("total_payment_amount").cast("decimal(18,2)")).drop("_period")


def crash_table(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/table").drop("_period")
