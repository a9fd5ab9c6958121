"""The benchmark tables seen as the domain's raw inputs.

Each input exists twice, as a DataFrame and as the SQL of the same rows, so that a query
and its check start from equal data. All rows of the tables are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog.base import table
from starloom.functions.dates import timestamp_to_epoch_ms

# ---- application log: events, with the part that props.k names as the song -----------

EVENTS_SQL = """
log AS (
  SELECT CASE WHEN event_type = 'purchase' THEN p_brand WHEN event_type = 'error' THEN '' END AS artist,
         'F' || user_id AS "firstName",
         CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(hour(ts) AS INTEGER) AS "itemInSession",
         'L' || (user_id % 10) AS "lastName",
         p_retailprice AS length,
         CASE WHEN value > 20 THEN 'paid' ELSE 'free' END AS level,
         'City ' || (user_id % 25) AS location,
         CASE WHEN event_type = 'purchase' THEN 'NextSong' ELSE event_type END AS page,
         user_id * 100 + day(ts) AS "sessionId",
         CASE WHEN event_type = 'purchase' THEN p_name END AS song,
         epoch_us(ts) // 1000 AS ts,
         'agent/' || (event_id % 7) AS "userAgent",
         user_id AS "userId"
  FROM events LEFT JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT)
)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").withColumn(
        "p_partkey", F.get_json_object("props", "$.k").try_cast("bigint")
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    is_play = F.col("event_type") == "purchase"
    return raw.join(part, "p_partkey", "left").select(
        F.when(is_play, F.col("p_brand")).when(F.col("event_type") == "error", "").alias("artist"),
        F.concat(F.lit("F"), F.col("user_id")).alias("firstName"),
        F.when(F.col("user_id") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.hour("ts").alias("itemInSession"),
        F.concat(F.lit("L"), F.col("user_id") % 10).alias("lastName"),
        F.col("p_retailprice").alias("length"),
        F.when(F.col("value") > 20, "paid").otherwise("free").alias("level"),
        F.concat(F.lit("City "), F.col("user_id") % 25).alias("location"),
        F.when(is_play, "NextSong").otherwise(F.col("event_type")).alias("page"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("sessionId"),
        F.when(is_play, F.col("p_name")).alias("song"),
        timestamp_to_epoch_ms(F.col("ts")).alias("ts"),
        F.concat(F.lit("agent/"), F.col("event_id") % 7).alias("userAgent"),
        F.col("user_id").alias("userId"),
    )


# ---- song metadata: parts; a brand is an artist, brand and name make a song -----------

SONGS_SQL = """
songs AS (
  SELECT p_brand || '/' || p_name AS song_id, p_name AS title,
         'A-' || p_brand AS artist_id, p_brand AS artist_name, p_type AS artist_location,
         p_size * 1.5 AS artist_latitude, p_size * -0.5 AS artist_longitude,
         p_retailprice + CAST(p_size AS DOUBLE) / 64 AS duration,
         1990 + p_size AS year
  FROM part
)"""


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.concat_ws("/", "p_brand", "p_name").alias("song_id"),
        F.col("p_name").alias("title"),
        F.concat(F.lit("A-"), F.col("p_brand")).alias("artist_id"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_type").alias("artist_location"),
        (F.col("p_size") * 1.5).alias("artist_latitude"),
        (F.col("p_size") * -0.5).alias("artist_longitude"),
        (F.col("p_retailprice") + F.col("p_size").cast("double") / 64).alias("duration"),
        (F.lit(1990) + F.col("p_size")).alias("year"),
    )


# ---- trips: line items -----------------------------------------------------------

TRIPS_SQL = """
trips AS (
  SELECT coalesce(nullif(l_suppkey % 3, 0), -1) AS vendor_key,
         CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS BIGINT) AS date_key,
         l_partkey % 25 AS pickup_location_key, l_suppkey % 25 AS drop_off_location_key,
         CAST(l_quantity AS BIGINT) AS passenger_count,
         CAST(l_extendedprice AS DECIMAL(18, 2)) AS total_payment_amount
  FROM lineitem
),
trip_fact AS (
  SELECT vendor_key, pickup_location_key, drop_off_location_key, date_key,
         CAST(sum(passenger_count) AS BIGINT) AS passenger_count,
         CAST(sum(total_payment_amount) AS DOUBLE) AS total_payment_amount,
         count(*) AS trip_count
  FROM trips GROUP BY ALL
)"""


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items under the trip file's column names."""
    return table(spark, sf_dir, "lineitem").select(
        F.nullif(F.col("l_suppkey") % 3, F.lit(0)).alias("VendorID"),
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.col("l_quantity").alias("passenger_count"),
        (F.col("l_partkey") % 25).alias("PULocationID"),
        (F.col("l_suppkey") % 25).alias("DOLocationID"),
        F.col("l_extendedprice").alias("total_amount"),
    )


# ---- crashes: orders, as the text columns of the crash file -----------------------

CRASHES_SQL = """
crashes AS (
  SELECT CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS BIGINT) AS date_key,
         CAST(o_custkey * 13 % 800 AS DOUBLE) / 8 AS longitude,
         CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
              ELSE CAST(o_orderkey * 29 % 800 AS DOUBLE) / 8 END AS latitude,
         o_orderkey % 3 AS persons_injured,
         CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS persons_killed,
         [CASE o_orderstatus WHEN 'F' THEN 'TAXI' WHEN 'O' THEN 'SEDAN' END,
                      CASE o_orderpriority WHEN '1-URGENT' THEN 'TAXI' WHEN '2-HIGH' THEN 'BUS' END] AS vehicles,
         [upper(o_orderpriority),
                      CASE o_orderstatus WHEN 'F' THEN 'UNSPECIFIED' END,
                      CASE WHEN o_custkey % 7 = 0 THEN 'BACKING UNSAFELY' END] AS factors,
         [CASE WHEN o_orderkey % 2 = 1 THEN 'Pedestrian' END,
                      CASE WHEN o_custkey % 5 = 0 THEN 'Cyclist' END,
                      CASE WHEN o_orderkey % 50 = 0 THEN 'Motorist' END] AS participants
  FROM orders
),
located AS (
  SELECT c.*, n_nationkey AS location_key
  FROM (SELECT * FROM crashes WHERE latitude IS NOT NULL) c
  LEFT JOIN nation ON c.longitude > n_nationkey % 5 * 20 AND c.longitude < n_nationkey % 5 * 20 + 20
                  AND c.latitude > n_nationkey // 5 * 20 AND c.latitude < n_nationkey // 5 * 20 + 20
),
crash_dim AS (
  SELECT date_key, location_key, count(*) AS crash_count,
         CAST(sum(persons_injured) AS BIGINT) AS person_injury_count,
         CAST(sum(persons_killed) AS BIGINT) AS person_kill_count,
         list_sort(list_distinct(flatten(list(factors)))) AS contributing_factor_list,
         list_sort(list_distinct(flatten(list(participants)))) AS impacted_participant_list,
         list_sort(list_distinct(flatten(list(vehicles)))) AS vehicle_type_list
  FROM located GROUP BY ALL
)"""


def _flag(condition: Column) -> Column:
    return F.when(condition, "1").otherwise("0")


def raw_crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    order_key, customer = F.col("o_orderkey"), F.col("o_custkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    no_latitude = (priority == "5-LOW") & (status == "P")
    nothing = F.lit(None).cast("string")
    columns = {
        "CRASH DATE": F.date_format("o_orderdate", "MM/dd/yyyy"),
        "LATITUDE": F.when(~no_latitude, (order_key * 29 % 800).cast("double") / 8).cast("string"),
        "LONGITUDE": ((customer * 13 % 800).cast("double") / 8).cast("string"),
        "COLLISION_ID": order_key.cast("string"),
        "NUMBER OF PERSONS INJURED": (order_key % 3).cast("string"),
        "NUMBER OF PERSONS KILLED": _flag(order_key % 50 == 0),
        "NUMBER OF PEDESTRIANS INJURED": (order_key % 2).cast("string"),
        "NUMBER OF PEDESTRIANS KILLED": F.lit("0"),
        "NUMBER OF CYCLIST INJURED": _flag(customer % 5 == 0),
        "NUMBER OF CYCLIST KILLED": F.lit("0"),
        "NUMBER OF MOTORIST INJURED": F.lit("0"),
        "NUMBER OF MOTORIST KILLED": _flag(order_key % 50 == 0),
        "VEHICLE TYPE CODE 1": F.when(status == "F", "Taxi").when(status == "O", "Sedan"),
        "VEHICLE TYPE CODE 2": F.when(priority == "1-URGENT", "TAXI").when(priority == "2-HIGH", "Bus"),
        "VEHICLE TYPE CODE 3": nothing,
        "VEHICLE TYPE CODE 4": nothing,
        "VEHICLE TYPE CODE 5": nothing,
        "CONTRIBUTING FACTOR VEHICLE 1": priority,
        "CONTRIBUTING FACTOR VEHICLE 2": F.when(status == "F", "Unspecified"),
        "CONTRIBUTING FACTOR VEHICLE 3": F.when(customer % 7 == 0, "Backing Unsafely"),
        "CONTRIBUTING FACTOR VEHICLE 4": nothing,
        "CONTRIBUTING FACTOR VEHICLE 5": nothing,
    }
    return table(spark, sf_dir, "orders").select(*[c.alias(n) for n, c in columns.items()])


# ---- zones: nations on a 5 × 5 board of squares ------------------------------------


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("n_name").alias("Zone"),
        F.col("r_name").alias("Borough"),
    )


def _edges(corners: list[tuple[Column, Column]]) -> Column:
    closed = [*corners, corners[0]]
    return F.array(
        *[
            F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
            for (x1, y1), (x2, y2) in zip(closed, closed[1:], strict=False)
        ]
    )


def zone_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = (F.col("LocationID") % 5 * 20).cast("double")
    y = (F.floor(F.col("LocationID") / 5) * 20).cast("double")
    return zone_lookup(spark, sf_dir).select(
        F.col("LocationID").cast("bigint").alias("ord"),
        F.col("LocationID").alias("location_id"),
        F.col("Zone").alias("zone"),
        F.col("Borough").alias("borough"),
        _edges([(x, y), (x + 20, y), (x + 20, y + 20), (x, y + 20)]).alias("edges"),
    )


# ---- areas: one polygon per supplier, in five shapes; points: events ----------------

# fixed values: corner offsets of the shapes' rings
SHAPES = {
    0: [[(-4, -4), (4, -4), (4, 4), (-4, 4)]],
    1: [[(-6, -6), (6, -6), (6, 6), (-6, 6)], [(-2, -2), (2, -2), (2, 2), (-2, 2)]],
    2: [[(-6, -6), (-2, -6), (-2, -2), (-6, -2)], [(2, 2), (6, 2), (6, 6), (2, 6)]],
    3: [[(-5, -5), (5, -5), (0, 5)]],
    4: [[(-6, -6), (6, -6), (6, 0), (0, 0), (0, 6), (-6, 6)]],
}


def _shape_edges(kind: int) -> list[tuple[int, int, int, int]]:
    return [
        (*a, *b) for ring in SHAPES[kind] for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)
    ]


AREAS_SQL = """
offsets(kind, x1, y1, x2, y2) AS (VALUES {values}),
areas AS (
  SELECT s_suppkey AS ord, s_name AS zone, CAST(s_nationkey AS VARCHAR) AS borough,
         cx + x1 AS x1, cy + y1 AS y1, cx + x2 AS x2, cy + y2 AS y2
  FROM (SELECT *, CAST(s_suppkey * 37 % 400 AS DOUBLE) / 2 AS cx,
               CAST(s_suppkey * 91 % 400 AS DOUBLE) / 2 AS cy FROM supplier)
  JOIN offsets ON kind = s_suppkey % 5
),
points AS (
  SELECT event_id, CAST(event_id * 7919 % 1600 AS DOUBLE) / 8 AS x,
         CASE WHEN event_type <> 'error' THEN CAST(event_id * 104729 % 1600 AS DOUBLE) / 8 END AS y
  FROM events
)""".format(
    values=", ".join(str((kind, *edge)) for kind in SHAPES for edge in _shape_edges(kind))
)


def area_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    cx = (F.col("s_suppkey") * 37 % 400).cast("double") / 2
    cy = (F.col("s_suppkey") * 91 % 400).cast("double") / 2

    def edges(kind: int) -> Column:
        return F.array(
            *[
                F.struct(
                    (cx + x1).alias("x1"), (cy + y1).alias("y1"), (cx + x2).alias("x2"), (cy + y2).alias("y2")
                )
                for x1, y1, x2, y2 in _shape_edges(kind)
            ]
        )

    shape = F.when(F.col("s_suppkey") % 5 == 0, edges(0))
    for kind in (1, 2, 3, 4):
        shape = shape.when(F.col("s_suppkey") % 5 == kind, edges(kind))
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("ord"),
        F.col("s_suppkey").cast("int").alias("location_id"),
        F.col("s_name").alias("zone"),
        F.col("s_nationkey").cast("string").alias("borough"),
        shape.alias("edges"),
    )


EVENTS_PILE_SQL = """
pile AS (
  SELECT c_custkey AS ord, CAST(c_custkey * 6101 % 257 AS DOUBLE) / 64 AS px,
         CAST(c_custkey * 3571 % 251 AS DOUBLE) / 64 AS py FROM customer
),
points AS (
  SELECT event_id, CAST(event_id * 7919 % 800 AS DOUBLE) / 64 AS x,
         CAST(event_id * 104729 % 800 AS DOUBLE) / 64 AS y FROM events
)"""


def piled_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One square of 8 by 8 per customer, all over one spot."""
    x = (F.col("c_custkey") * 6101 % 257).cast("double") / 64
    y = (F.col("c_custkey") * 3571 % 251).cast("double") / 64
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("bigint").alias("ord"),
        F.col("c_custkey").cast("int").alias("location_id"),
        F.lit("").alias("zone"),
        F.lit("").alias("borough"),
        _edges([(x, y), (x + 8, y), (x + 8, y + 8), (x, y + 8)]).alias("edges"),
    )


def event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        ((F.col("event_id") * 7919 % 1600).cast("double") / 8).alias("x"),
        F.when(
            F.col("event_type") != "error", (F.col("event_id") * 104729 % 1600).cast("double") / 8
        ).alias("y"),
    )
