"""Trips × crashes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import inputs
from starloom.catalog.base import Registry, table
from starloom.functions.dates import date_key
from starloom.operators.joins import any_key_join, hot_keys
from starloom.operators.sinks import write_parquet
from starloom.operators.spatial import locate_points
from starloom.plans import city
from starloom.session import work_path
from starloom.sources.files import read_parquet

QUERIES = Registry()


def _trip_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city.trip_fact(city.clean_trips(inputs.raw_trips(spark, sf_dir)))


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city.locate_crashes(
        city.clean_crashes(inputs.raw_crashes(spark, sf_dir)), inputs.zone_polygons(spark, sf_dir)
    )


_stored: dict[tuple, str] = {}


def _input_state(spark: SparkSession, sf_dir: str, *names: str) -> tuple:
    """Names, sizes and times of the files of some tables; no content is read."""
    files = spark.read.option("recursiveFileLookup", "true").format("binaryFile")
    listed = files.load([f"{sf_dir.rstrip('/')}/{n}.parquet" for n in names]).select("path", "length", "modificationTime")
    return tuple(sorted(tuple(r) for r in listed.collect()))


def _crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crash dimension of located crashes; they are located once per state of the input files."""
    key = (spark.sparkContext.applicationId, sf_dir, _input_state(spark, sf_dir, "orders", "nation", "region"))
    if key not in _stored:
        path = work_path(spark, "crashes_located")
        write_parquet(_located(spark, sf_dir), path)
        _stored[key] = path
    return city.crash_dim(read_parquet(spark, _stored[key]))


def _star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    return (
        _trip_fact(spark, sf_dir),
        city.vendor_dim(spark),
        city.date_dim(spark, start="1995-01-01"),
        city.location_dim(inputs.zone_lookup(spark, sf_dir)),
        _crashes(spark, sf_dir),
    )


_DIMS_SQL = """
vendor_dim(vendor_key, name) AS (
  VALUES (1, 'Creative Mobile Technologies'), (2, 'VeriFone Inc.'), (-1, 'Not Available')
),
days AS (SELECT unnest(range(DATE '1995-01-01', DATE '1995-01-01' + 10000, INTERVAL 1 DAY)) AS d),
date_dim AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS date_key,
         CAST(day(d) AS BIGINT) AS day, CAST(week(d) AS BIGINT) AS week,
         CAST(month(d) AS BIGINT) AS month, CAST(quarter(d) AS BIGINT) AS quarter,
         CAST(year(d) AS BIGINT) AS year
  FROM days
),
location_dim AS (
  SELECT n_nationkey AS location_key, n_name AS zone, r_name AS borough
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


@QUERIES.add(f"WITH {inputs.TRIPS_SQL} SELECT * FROM trip_fact")
def trip_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trip_fact(spark, sf_dir)


@QUERIES.add(f"""
WITH {inputs.CRASHES_SQL}
SELECT date_key, CAST(location_key AS BIGINT) AS location_key,
       crash_count, person_injury_count, person_kill_count,
       array_to_string(contributing_factor_list, '|') AS contributing_factor_list,
       coalesce(array_to_string(impacted_participant_list, '|'), '') AS impacted_participant_list,
       coalesce(array_to_string(vehicle_type_list, '|'), '') AS vehicle_type_list
FROM crash_dim
""")
def crash_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city.crash_dim(_located(spark, sf_dir))


@QUERIES.add(f"""
WITH {_DIMS_SQL}
SELECT d.*, coalesce(n, 0) AS orders_on_day
FROM date_dim d LEFT JOIN (
  SELECT CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS BIGINT) AS date_key,
         count(*) AS n
  FROM orders GROUP BY 1
) USING (date_key)
""")
def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar, with the number of orders on each day."""
    per_day = (
        table(spark, sf_dir, "orders")
        .groupBy(date_key(F.col("o_orderdate")).alias("date_key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        city.date_dim(spark, start="1995-01-01")
        .join(per_day, "date_key", "left")
        .withColumn("orders_on_day", F.coalesce("n", F.lit(0)))
        .drop("n")
    )


@QUERIES.add(f"""
WITH {_DIMS_SQL}, {inputs.TRIPS_SQL}
SELECT CAST(v.vendor_key AS BIGINT) AS vendor_key, name, count(t.vendor_key) AS trips
FROM vendor_dim v LEFT JOIN trips t ON v.vendor_key = t.vendor_key GROUP BY ALL
""")
def vendor_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vendors, with the number of trips of each."""
    per_vendor = (
        city.clean_trips(inputs.raw_trips(spark, sf_dir))
        .groupBy("vendor_key")
        .agg(F.count(F.lit(1)).alias("trips"))
    )
    return city.vendor_dim(spark).join(per_vendor, "vendor_key", "left").fillna(0, ["trips"])


@QUERIES.add("""
SELECT c_custkey AS location_key, c_name AS zone, n_name AS borough
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def location_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a zone lookup file."""
    zones = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return city.location_dim(
        zones.select(
            F.col("c_custkey").cast("string").alias("LocationID"),
            F.col("c_name").alias("Zone"),
            F.col("n_name").alias("Borough"),
        )
    )


_ANY_KEY_SQL = """
SELECT CAST(n_nationkey AS BIGINT) AS location_key, count(*) AS trips,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS amount
FROM lineitem JOIN nation ON l_partkey % 25 = n_nationkey OR l_suppkey % 25 = n_nationkey
GROUP BY ALL
"""


@QUERIES.add(_ANY_KEY_SQL)
def any_key_join_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips that start or end in a zone."""
    trips = city.clean_trips(inputs.raw_trips(spark, sf_dir))
    zones = city.location_dim(inputs.zone_lookup(spark, sf_dir))
    return (
        any_key_join(trips, zones, ["pickup_location_key", "drop_off_location_key"], "location_key")
        .groupBy("location_key")
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("total_payment_amount").alias("amount"))
    )


@QUERIES.add(_ANY_KEY_SQL)
def any_key_join_hot_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the busiest zones spread over many tasks."""
    trips = city.clean_trips(inputs.raw_trips(spark, sf_dir))
    zones = city.location_dim(inputs.zone_lookup(spark, sf_dir))
    ends = ["pickup_location_key", "drop_off_location_key"]
    hot = hot_keys(trips.select(F.col(ends[0]).alias("location_key")), ["location_key"], 0.02)
    return (
        any_key_join(trips, zones, ends, "location_key", hot)
        .groupBy("location_key")
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("total_payment_amount").alias("amount"))
    )


@QUERIES.add(f"""
WITH {inputs.CRASHES_SQL}
SELECT count(*) AS crash_rows FROM crash_dim WHERE list_contains(vehicle_type_list, 'TAXI')
""")
def taxi_crash_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city.count_crashes_with(_crashes(spark, sf_dir))


# the ends of the trips in one column, an end that repeats the other only once
_REPORT_SQL = f"""WITH {inputs.TRIPS_SQL}, {inputs.CRASHES_SQL}, {_DIMS_SQL},
ends AS (
  SELECT vendor_key, date_key, pickup_location_key AS location_key FROM trip_fact
  UNION ALL
  SELECT vendor_key, date_key, drop_off_location_key FROM trip_fact
  WHERE drop_off_location_key IS DISTINCT FROM pickup_location_key
),
met AS (
  SELECT name AS vendor, crash_count, contributing_factor_list
  FROM ends JOIN crash_dim USING (date_key, location_key) JOIN vendor_dim USING (vendor_key)
  WHERE list_contains(vehicle_type_list, 'TAXI')
    AND EXISTS (FROM date_dim WHERE date_dim.date_key = ends.date_key)
    AND EXISTS (FROM location_dim WHERE location_dim.location_key = ends.location_key)
)"""


@QUERIES.add(f"{_REPORT_SQL} SELECT vendor, CAST(sum(crash_count) AS BIGINT) AS crash_count FROM met GROUP BY vendor")
def vendor_crash_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city.vendor_crash_count(*_star(spark, sf_dir))


def _top_factors_sql(n: int) -> str:
    return f"""{_REPORT_SQL},
counted AS (
  SELECT vendor, factor, count(*) AS factor_count
  FROM (SELECT vendor, unnest(contributing_factor_list) AS factor FROM met) GROUP BY ALL
)
SELECT *, 1 + (SELECT count(*) FROM counted more
               WHERE more.vendor = c.vendor AND more.factor_count > c.factor_count) AS rank
FROM counted c
WHERE (SELECT count(*) FROM counted more
       WHERE more.vendor = c.vendor AND more.factor_count > c.factor_count) < {n}"""


@QUERIES.add(_top_factors_sql(3))
def vendor_top_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city.vendor_top_factors(*_star(spark, sf_dir), n=3).orderBy("vendor", "rank")


@QUERIES.add(_top_factors_sql(10))
def vendor_top_ten_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return city.vendor_top_factors(*_star(spark, sf_dir)).orderBy("vendor", "rank")


def _located_sql(shapes: str) -> str:
    return f"""
WITH {inputs.AREAS_SQL},
shapes AS ({shapes}),
hits AS (
  SELECT event_id, ord, any_value(zone) AS zone, any_value(borough) AS borough
  FROM points JOIN shapes ON y IS NOT NULL
  GROUP BY event_id, ord
  HAVING count_if((y1 > y) <> (y2 > y) AND x < x1 + (x2 - x1) * (y - y1) / nullif(y2 - y1, 0)) % 2 = 1
     AND count_if((x2 - x1) * (y - y1) = (y2 - y1) * (x - x1)
                  AND x BETWEEN least(x1, x2) AND greatest(x1, x2)
                  AND y BETWEEN least(y1, y2) AND greatest(y1, y2)) = 0
)
SELECT p.event_id, h.ord AS location_id, h.zone, h.borough
FROM points p LEFT JOIN (
  SELECT event_id, min(ord) AS ord, arg_min(zone, ord) AS zone, arg_min(borough, ord) AS borough
  FROM hits GROUP BY event_id
) h USING (event_id)
"""


def _located_events(spark: SparkSession, sf_dir: str, polygons: DataFrame, **options: object) -> DataFrame:
    points = inputs.event_points(spark, sf_dir)
    located = locate_points(points, polygons, "x", "y", alias="area", **options)
    return located.select("event_id", "area.location_id", "area.zone", "area.borough")


@QUERIES.add(_located_sql("FROM areas"))
def locate_points_in_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's point with the first supplier area that contains it."""
    return _located_events(spark, sf_dir, inputs.area_polygons(spark, sf_dir))


@QUERIES.add(_located_sql("FROM areas"))
def locate_points_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same when the grids are too large to be broadcast."""
    return _located_events(spark, sf_dir, inputs.area_polygons(spark, sf_dir), broadcast_bytes=0)


@QUERIES.add(_located_sql("""
  SELECT ord, zone, borough, x1 * f AS x1, y1 * f AS y1, x2 * f AS x2, y2 * f AS y2
  FROM (SELECT *, CASE WHEN ord % 9 = 0 THEN 16 ELSE 1 END AS f FROM areas)"""))
def locate_points_mixed_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth area sixteen times as large: two grids."""
    areas = inputs.area_polygons(spark, sf_dir)
    f = F.when(F.col("ord") % 9 == 0, 16).otherwise(1)
    grown = F.transform(
        "edges", lambda e: F.struct(*[(e[c] * f).alias(c) for c in ("x1", "y1", "x2", "y2")])
    )
    return _located_events(spark, sf_dir, areas.withColumn("edges", grown))


@QUERIES.add(f"""
WITH {inputs.EVENTS_PILE_SQL},
hits AS (
  SELECT event_id, min(ord) AS ord FROM points JOIN pile ON x > px AND x < px + 8 AND y > py AND y < py + 8
  GROUP BY event_id)
SELECT event_id, ord AS location_id FROM points LEFT JOIN hits USING (event_id)
""")
def locate_points_in_a_pile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many equally large squares over one spot, one per customer: crowded cells are split."""
    points = table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") * 7919 % 800).cast("double") / 64, (F.col("event_id") * 104729 % 800).cast("double") / 64
    ).toDF("event_id", "x", "y")
    located = locate_points(points, inputs.piled_squares(spark, sf_dir), "x", "y", alias="area")
    return located.select("event_id", "area.location_id")
