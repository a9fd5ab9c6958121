"""Taxi trips × traffic crashes: daily facts, dimensions and cross-domain reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.arrays import flag_labels, label_array
from starloom.functions.casts import fill_unknown, lenient_cast
from starloom.functions.dates import date_key
from starloom.operators.aggregates import collect_distinct_elements, global_count
from starloom.operators.joins import explode_keys
from starloom.operators.quality import require
from starloom.operators.ranking import top_n_per_group
from starloom.operators.spatial import locate_points

# ---- fixed values: vendor rows, crash file columns, defaults ----------------------

VENDORS = [
    (1, "Creative Mobile Technologies"),
    (2, "VeriFone Inc."),
    (-1, "Not Available"),
]
UNKNOWN_KEY = -1
CALENDAR_START = "2014-01-01"
CALENDAR_DAYS = 10000
TRIP_ENDS = ["pickup_location_key", "drop_off_location_key"]
CRASH_DATE_FORMAT = "MM/dd/yyyy"
VEHICLE_COLUMNS = [f"VEHICLE TYPE CODE {i}" for i in range(1, 6)]
FACTOR_COLUMNS = [f"CONTRIBUTING FACTOR VEHICLE {i}" for i in range(1, 6)]
CASUALTY_COLUMNS = {
    "persons_injured": "NUMBER OF PERSONS INJURED",
    "persons_killed": "NUMBER OF PERSONS KILLED",
    "pedestrians_injured": "NUMBER OF PEDESTRIANS INJURED",
    "pedestrians_killed": "NUMBER OF PEDESTRIANS KILLED",
    "cyclists_injured": "NUMBER OF CYCLIST INJURED",
    "cyclists_killed": "NUMBER OF CYCLIST KILLED",
    "motorists_injured": "NUMBER OF MOTORIST INJURED",
    "motorists_killed": "NUMBER OF MOTORIST KILLED",
}
PARTICIPANTS = {
    "Pedestrian": ("pedestrians_injured", "pedestrians_killed"),
    "Cyclist": ("cyclists_injured", "cyclists_killed"),
    "Motorist": ("motorists_injured", "motorists_killed"),
}


# ---- dimensions ------------------------------------------------------------------


def vendor_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VENDORS, "vendor_key int, name string")


def location_dim(zones: DataFrame) -> DataFrame:
    """Zone lookup file (LocationID, Zone, Borough) → location dimension."""
    return zones.select(
        lenient_cast(F.col("LocationID"), "int").alias("location_key"),
        F.col("Zone").alias("zone"),
        F.col("Borough").alias("borough"),
    )


def date_dim(
    spark: SparkSession, start: str = CALENDAR_START, days: int = CALENDAR_DAYS
) -> DataFrame:
    """One row per calendar day from ``start`` on."""
    day = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    return spark.range(days).select(
        date_key(day).alias("date_key"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
    )


# ---- trips -----------------------------------------------------------------------


def clean_trips(raw: DataFrame) -> DataFrame:
    """Raw trip rows, all text → typed columns; a missing vendor becomes ``-1``."""
    return raw.select(
        fill_unknown(lenient_cast(F.col("VendorID"), "int"), UNKNOWN_KEY).alias("vendor_key"),
        lenient_cast(F.col("tpep_pickup_datetime"), "timestamp").cast("date").alias("trip_date"),
        lenient_cast(F.col("passenger_count"), "int").alias("passenger_count"),
        lenient_cast(F.col("PULocationID"), "int").alias("pickup_location_key"),
        lenient_cast(F.col("DOLocationID"), "int").alias("drop_off_location_key"),
        lenient_cast(F.col("total_amount"), "decimal(18,2)").alias("total_payment_amount"),
    )


def trip_fact(trips: DataFrame) -> DataFrame:
    """Cleaned trips rolled up per vendor, day, pick-up and drop-off location."""
    return trips.groupBy(
        "vendor_key",
        "pickup_location_key",
        "drop_off_location_key",
        date_key(F.col("trip_date")).alias("date_key"),
    ).agg(
        F.sum("passenger_count").alias("passenger_count"),
        F.sum("total_payment_amount").cast("decimal(18,2)").alias("total_payment_amount"),
        F.count(F.lit(1)).alias("trip_count"),
    )


# ---- crashes ---------------------------------------------------------------------


def clean_crashes(
    raw: DataFrame,
    date_format: str = CRASH_DATE_FORMAT,
    required: Sequence[str] = ("crash_date", "latitude", "longitude", "collision_id"),
    any_of: Sequence[str] = (),
) -> DataFrame:
    """Raw crash rows, all text → typed columns and label arrays.

    Rows lacking a ``required`` column are dropped, and rows lacking all of ``any_of``.
    """
    typed = raw.select(
        F.try_to_date(F.col("CRASH DATE"), date_format).alias("crash_date"),
        lenient_cast(F.col("LATITUDE"), "double").alias("latitude"),
        lenient_cast(F.col("LONGITUDE"), "double").alias("longitude"),
        lenient_cast(F.col("COLLISION_ID"), "int").alias("collision_id"),
        *[lenient_cast(F.col(f"`{c}`"), "int").alias(n) for n, c in CASUALTY_COLUMNS.items()],
        label_array(VEHICLE_COLUMNS).alias("vehicle_type_list"),
        label_array(FACTOR_COLUMNS).alias("contributing_factor_list"),
    )
    return require(typed, required, any_of).withColumn(
        "impacted_participant_list",
        flag_labels(
            {label: (F.col(a) > 0) | (F.col(b) > 0) for label, (a, b) in PARTICIPANTS.items()}
        ),
    )


def locate_crashes(crashes: DataFrame, polygons: DataFrame, **options: object) -> DataFrame:
    """Add ``taxi_zone`` (location_id, zone, borough): the zone a crash happened in."""
    return locate_points(crashes, polygons, "longitude", "latitude", alias="taxi_zone", **options)


CRASH_LISTS = ("contributing_factor_list", "impacted_participant_list", "vehicle_type_list")


def crash_measures() -> dict[str, Column]:
    return {
        "crash_count": F.lit(1),
        "person_injury_count": F.col("persons_injured"),
        "person_kill_count": F.col("persons_killed"),
    }


def keyed_crashes(located: DataFrame) -> DataFrame:
    """What the roll-up of located crashes needs of them."""
    return located.select(
        date_key(F.col("crash_date")).alias("date_key"),
        F.col("taxi_zone.location_id").alias("location_key"),
        "persons_injured",
        "persons_killed",
        *CRASH_LISTS,
    )


def crash_dim(located: DataFrame) -> DataFrame:
    """Located crashes rolled up per day and zone, with their distinct labels."""
    return collect_distinct_elements(
        keyed_crashes(located), ["date_key", "location_key"], {name: name for name in CRASH_LISTS}, crash_measures()
    )


# ---- reports ---------------------------------------------------------------------


def count_crashes_with(crashes: DataFrame, vehicle: str = "TAXI") -> DataFrame:
    """Number of crash rows (day × zone) that involve a vehicle type."""
    return global_count(
        crashes.where(F.array_contains("vehicle_type_list", vehicle)), "crash_rows"
    )


def _vendor_exposure(
    trips: DataFrame, vendors: DataFrame, dates: DataFrame, locations: DataFrame
) -> DataFrame:
    """(vendor, date_key, location_key) → number of trip_fact rows that touch the location.

    The star join fans every fact row out to its one or two locations and then to crashes.
    The reports only need how many fact rows stand behind each combination, so they are
    counted here, before the crashes are joined: at most vendors × days × zones rows
    remain, however many trips there are and however crowded a zone is.
    """
    ends = trips.select("vendor_key", "date_key", *TRIP_ENDS)
    touched = (
        explode_keys(ends, TRIP_ENDS, "location_key")
        .groupBy("vendor_key", "date_key", "location_key")
        .agg(F.count(F.lit(1)).alias("fact_rows"))
    )
    return (
        touched.join(vendors.select("vendor_key", F.col("name").alias("vendor")), "vendor_key")
        .join(dates.select("date_key"), "date_key")
        .join(locations.select("location_key"), "location_key")
    )


def vendor_crash_count(
    trips: DataFrame,
    vendors: DataFrame,
    dates: DataFrame,
    locations: DataFrame,
    crashes: DataFrame,
    vehicle: str = "TAXI",
) -> DataFrame:
    """Crashes near a vendor's trips: same day, same pick-up or drop-off zone.

    A crash row counts once per fact row and location it meets.
    """
    involved = crashes.where(F.array_contains("vehicle_type_list", vehicle)).select(
        "date_key", "location_key", "crash_count"
    )
    return (
        _vendor_exposure(trips, vendors, dates, locations)
        .join(involved, ["date_key", "location_key"])
        .groupBy("vendor")
        .agg(F.sum(F.col("crash_count") * F.col("fact_rows")).alias("crash_count"))
    )


def vendor_top_factors(
    trips: DataFrame,
    vendors: DataFrame,
    dates: DataFrame,
    locations: DataFrame,
    crashes: DataFrame,
    vehicle: str = "TAXI",
    n: int = 10,
) -> DataFrame:
    """Most frequent contributing factors of crashes near each vendor's trips."""
    involved = crashes.where(F.array_contains("vehicle_type_list", vehicle)).select(
        "date_key", "location_key", F.explode("contributing_factor_list").alias("factor")
    )
    counts = (
        _vendor_exposure(trips, vendors, dates, locations)
        .join(involved, ["date_key", "location_key"])
        .groupBy("vendor", "factor")
        .agg(F.sum("fact_rows").alias("factor_count"))
    )
    return top_n_per_group(counts, ["vendor"], "factor_count", n)
