"""Whole refreshes: raw files written out, loaded by the pipelines, tables read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import inputs
from starloom.catalog.base import Registry
from starloom.catalog.storage import zone_document
from starloom.functions.dates import timestamp_to_epoch_ms
from starloom.operators.sinks import write_csv_quoted
from starloom.operators.publish import current, read_published
from starloom.operators.quality import DataQualityError
from starloom.plans import city, daily, music
from starloom.plans.model import drop_model
from starloom.plans.pipelines import run_city_pipeline, run_lake_pipeline, run_music_pipeline
from starloom.schemas import MUSIC_MODEL
from starloom.session import work_path
from starloom.streaming.refresh import refresh_music_by_batch

QUERIES = Registry()

_DATABASE = "starloom_refresh"
_ONE_SONG = """one_song AS (SELECT * FROM songs QUALIFY 1 = row_number() OVER (
  PARTITION BY song_id ORDER BY artist_id, title, artist_name, duration))"""


@QUERIES.add(f"""
WITH {inputs.EVENTS_SQL}, {inputs.SONGS_SQL},
known AS (SELECT song_id, title, artist_name, min(year) < 2010 AS early FROM songs GROUP BY ALL),
play AS (SELECT * FROM log WHERE page = 'NextSong'),
one_play AS (SELECT DISTINCT "sessionId", ts, "userId", "itemInSession", song, artist, length, level, location,
  "userAgent" FROM play)
SELECT 'songplays' AS loaded, "sessionId" AS number, ts AS millis, song_id AS name
FROM one_play LEFT JOIN known ON song = title AND artist = artist_name AND (early OR level = 'paid')
UNION ALL SELECT DISTINCT 'users', "userId", NULL, "firstName" FROM play
UNION ALL SELECT DISTINCT 'songs', NULL, NULL, song_id FROM songs
UNION ALL SELECT DISTINCT 'artists', NULL, NULL, artist_id FROM songs
UNION ALL SELECT DISTINCT 'time', NULL, ts, NULL FROM play
""")
def music_refresh_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of log and song files, sessions going on from one to the other; the third run is idle.

    A play takes its song from what was staged when it was loaded.
    """
    drop_model(spark, "music", _DATABASE) if spark.catalog.databaseExists(_DATABASE) else None
    place, logs, metadata = (work_path(spark, f"refresh_{x}") for x in ("tables", "logs", "songs"))
    log, songs = inputs.events(spark, sf_dir), inputs.songs(spark, sf_dir)
    by_year = F.col("year") < 2010
    for paid in ("free", "paid", None):
        if paid:
            log.where(F.col("level") == paid).write.mode("append").json(logs)
            songs.where(by_year if paid == "free" else ~by_year).write.mode("append").json(metadata)
        run_music_pipeline(
            spark, logs, metadata, _DATABASE, location=place, match_on=("title", "artist_name")
        )

    def table(name: str) -> DataFrame:
        return spark.table(f"{_DATABASE}.{name}")

    def rows(name: str, number: object = None, millis: object = None, text: object = None) -> DataFrame:
        return table(name).select(
            F.lit(name).alias("loaded"),
            (F.lit(None) if number is None else F.col(number)).cast("bigint").alias("number"),
            (F.lit(None) if millis is None else timestamp_to_epoch_ms(F.col(millis))).cast("bigint").alias("millis"),
            (F.lit(None) if text is None else F.col(text)).cast("string").alias("name"),
        )

    return (
        rows("songplays", "session_id", "start_time", "song_id")
        .unionByName(rows("users", "user_id", None, "first_name"))
        .unionByName(rows("songs", None, None, "song_id"))
        .unionByName(rows("artists", None, None, "artist_id"))
        .unionByName(rows("time", None, "start_time", None))
    )


_ODD_LOG_SQL = """
odd AS (
  SELECT * REPLACE (CASE WHEN "userId" % 10 = 3 THEN NULL ELSE "sessionId" END AS "sessionId") FROM log
  UNION ALL
  SELECT * REPLACE ("itemInSession" + 100 AS "itemInSession",
    CASE WHEN "userId" % 10 = 3 THEN NULL ELSE "sessionId" END AS "sessionId") FROM log WHERE "userId" % 4 = 1)"""


def _odd_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log without some sessions, and with two items in one millisecond of others."""
    log = inputs.events(spark, sf_dir)
    # from one scan of the log: an item that is doubled is two rows
    item = F.col("itemInSession")
    items = F.when(F.col("userId") % 4 == 1, F.array(item, item + 100)).otherwise(F.array(item))
    session = F.when(F.col("userId") % 10 != 3, F.col("sessionId"))
    doubled = log.select("*", F.explode(items).alias("_item"))
    return doubled.withColumns({"itemInSession": F.col("_item"), "sessionId": session}).drop("_item")


def _published(spark: SparkSession, root: str) -> DataFrame:
    """Keys of all published rows of the music tables."""
    manifest = current(spark, root)

    def rows(name: str, number: str | None, item: str | None, millis: str | None, text: str | None) -> DataFrame:
        found = read_published(spark, root, name, MUSIC_MODEL[name], manifest)
        return found.select(
            F.lit(name).alias("loaded"),
            (F.col(number) if number else F.lit(None)).cast("bigint").alias("number"),
            (F.col(item) if item else F.lit(None)).cast("bigint").alias("other"),
            (timestamp_to_epoch_ms(F.col(millis)) if millis else F.lit(None)).cast("bigint").alias("millis"),
            (F.col(text) if text else F.lit(None)).cast("string").alias("name"),
        )

    return (
        rows("songplays", "session_id", "user_id", "start_time", "song_id")
        .unionByName(rows("users", "user_id", None, None, "first_name"))
        .unionByName(rows("songs", None, None, None, "song_id"))
        .unionByName(rows("artists", None, None, None, "artist_id"))
        .unionByName(rows("time", None, None, "start_time", None))
    )


def _published_sql(known: str, wanted: str) -> str:
    """known: songs that were published when a play was loaded; wanted: plays that are published."""
    return f"""
WITH {inputs.EVENTS_SQL}, {inputs.SONGS_SQL}, {_ODD_LOG_SQL},
known AS (SELECT song_id, title, artist_name, min(year) < 2010 AS early FROM songs GROUP BY ALL),
play AS (SELECT * FROM odd WHERE page = 'NextSong' AND ({wanted})),
one_play AS (SELECT DISTINCT "sessionId", ts, "userId", "itemInSession", song, artist, length, level, location,
  "userAgent" FROM play)
SELECT 'songplays' AS loaded, "sessionId" AS number, "userId" AS other, ts AS millis, song_id AS name
FROM one_play LEFT JOIN known ON song = title AND artist = artist_name AND ({known})
UNION ALL SELECT DISTINCT 'users', "userId", NULL, NULL, "firstName" FROM play
UNION ALL SELECT DISTINCT 'songs', NULL, NULL, NULL, song_id FROM known
UNION ALL SELECT DISTINCT 'artists', NULL, NULL, NULL, 'A-' || artist_name FROM known
UNION ALL SELECT DISTINCT 'time', NULL, NULL, ts, NULL FROM play
"""


@QUERIES.add(_published_sql("early OR level = 'paid'", "true"))
def music_refresh_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of files, a third that repeats old plays, and an idle run.

    Plays of one millisecond all stay; plays without a session come once. A play takes its song
    from what was published when it was loaded.
    """
    root, logs, metadata = (work_path(spark, f"by_batch_{x}") for x in ("tables", "logs", "songs"))
    log, songs = _odd_log(spark, sf_dir), inputs.songs(spark, sf_dir)
    early = F.col("year") < 2010
    for batch in ("free", "paid", "free", None):
        if batch:
            log.where(F.col("level") == batch).write.mode("append").json(logs)
            songs.where(early if batch == "free" else ~early).write.mode("append").json(metadata)
        refresh_music_by_batch(spark, logs, metadata, root, match_on=("title", "artist_name"))
    return _published(spark, root)


@QUERIES.add(_published_sql("early", "level = 'free'"))
def failed_batch_leaves_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with plays without a user fails its checks: no table of it is published.

    Songs are published by a stream of their own, and were good.
    """
    root, logs, metadata = (work_path(spark, f"failed_batch_{x}") for x in ("tables", "logs", "songs"))
    log, songs = _odd_log(spark, sf_dir), inputs.songs(spark, sf_dir)
    early = F.col("year") < 2010
    for batch in ("free", "paid", None):
        if batch:
            rows = log.where(F.col("level") == batch)
            if batch == "paid":
                rows = rows.withColumn("userId", F.when(F.col("userId") % 5 != 0, F.col("userId")))
            rows.write.mode("append").json(logs)
            songs.where(early if batch == "free" else ~early).write.mode("append").json(metadata)
        try:
            refresh_music_by_batch(spark, logs, metadata, root, match_on=("title", "artist_name"))
        except DataQualityError:
            if batch == "free":
                raise
        else:
            if batch != "free":
                raise RuntimeError("the failing batch was published")
    return _published(spark, root)


@QUERIES.add(f"""
WITH {inputs.EVENTS_SQL}, {inputs.SONGS_SQL}, {_ONE_SONG}
SELECT ts AS millis, "userId" AS user_id, "sessionId" AS session_id, song_id,
       CAST(year(make_timestamp(ts * 1000)) AS BIGINT) AS year,
       CAST(month(make_timestamp(ts * 1000)) AS BIGINT) AS month
FROM log JOIN one_song ON song = title AND artist = artist_name WHERE page = 'NextSong'
""")
def lake_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of the lake refresh, times with their fractions, read from its folders by year and month."""
    logs, metadata, out = (work_path(spark, f"lake_{x}") for x in ("logs", "songs", "out"))
    inputs.events(spark, sf_dir).write.json(logs)
    inputs.songs(spark, sf_dir).write.json(metadata)
    run_lake_pipeline(spark, logs, metadata, out)
    return spark.read.parquet(f"{out}/songplays_table").select(
        timestamp_to_epoch_ms(F.col("start_time")).alias("millis"),
        "user_id", "session_id", "song_id", "year", "month",
    )


@QUERIES.add(f"""
WITH {inputs.TRIPS_SQL}, {inputs.CRASHES_SQL}
SELECT 'trips' AS loaded, date_key, count(*) AS table_rows, CAST(sum(trip_count) AS BIGINT) AS counted,
       CAST(sum(passenger_count) AS BIGINT) AS people
FROM trip_fact GROUP BY date_key
UNION ALL
SELECT 'crashes', date_key, count(*), CAST(sum(crash_count) AS BIGINT), CAST(sum(person_injury_count) AS BIGINT)
FROM crash_dim GROUP BY date_key
""")
def city_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and crashes per day after a refresh from CSV and GeoJSON files."""
    drop_model(spark, "city", _DATABASE) if spark.catalog.databaseExists(_DATABASE) else None
    trips, crashes, zones, polygons, place = (
        work_path(spark, f"city_{x}") for x in ("trips", "crashes", "zones", "polygons", "tables")
    )
    write_csv_quoted(inputs.raw_trips(spark, sf_dir), trips)
    write_csv_quoted(inputs.raw_crashes(spark, sf_dir), crashes)
    write_csv_quoted(inputs.zone_lookup(spark, sf_dir), zones)
    zone_document(inputs.zone_polygons(spark, sf_dir)).write.text(polygons)
    spark.sql(f"DROP TABLE IF EXISTS {_DATABASE}.crashes_located") if spark.catalog.databaseExists(_DATABASE) else None
    run_city_pipeline(spark, trips, crashes, zones, polygons, _DATABASE, location=place)

    def per_day(name: str, table: str, counted: str, people: str) -> DataFrame:
        return spark.table(f"{_DATABASE}.{table}").groupBy("date_key").agg(
            F.lit(name).alias("loaded"),
            F.count(F.lit(1)).alias("table_rows"),
            F.sum(counted).alias("counted"),
            F.sum(people).alias("people"),
        )

    return per_day("trips", "trip_fact", "trip_count", "passenger_count").unionByName(
        per_day("crashes", "crash_dim", "crash_count", "person_injury_count")
    )


@QUERIES.add(f"""
WITH {inputs.CRASHES_SQL},
kept AS (
  SELECT * REPLACE (CASE WHEN persons_injured = 1 THEN NULL ELSE longitude END AS longitude) FROM crashes
  WHERE latitude IS NOT NULL OR persons_injured <> 1),
zoned AS (
  SELECT CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN n_nationkey END AS location_key, persons_injured
  FROM kept LEFT JOIN nation
    ON longitude > n_nationkey % 5 * 20 AND longitude < n_nationkey % 5 * 20 + 20
   AND latitude > n_nationkey // 5 * 20 AND latitude < n_nationkey // 5 * 20 + 20)
SELECT CAST(location_key AS BIGINT) AS location_key, count(*) AS crashes,
       CAST(sum(persons_injured) AS BIGINT) AS injured
FROM zoned GROUP BY ALL
""")
def crashes_with_either_coordinate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crashes per zone when one known coordinate is enough to be kept, without a zone then.

    Some lack the latitude, some the longitude; those that lack both are dropped.
    """
    raw = inputs.raw_crashes(spark, sf_dir).withColumn(
        "LONGITUDE", F.when(F.col("NUMBER OF PERSONS INJURED") != "1", F.col("LONGITUDE"))
    )
    crashes = city.clean_crashes(raw, required=("crash_date",), any_of=("latitude", "longitude"))
    located = city.locate_crashes(crashes, inputs.zone_polygons(spark, sf_dir))
    return located.groupBy(F.col("taxi_zone.location_id").alias("location_key")).agg(
        F.count(F.lit(1)).alias("crashes"), F.sum("persons_injured").alias("injured")
    )


@QUERIES.add(f"""
WITH {inputs.EVENTS_SQL}
SELECT DISTINCT ts AS millis, CAST(hour(make_timestamp(ts * 1000)) AS BIGINT) AS hour FROM log
""")
def time_dim_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times to the millisecond."""
    times = music.time_dim(inputs.events(spark, sf_dir), whole_seconds=False)
    return times.select(timestamp_to_epoch_ms(F.col("start_time")).alias("millis"), "hour")


_ROLLED_SQL = f"""
WITH {inputs.TRIPS_SQL}, {inputs.CRASHES_SQL}
SELECT 'trips' AS loaded, date_key, vendor_key AS first, pickup_location_key AS second, drop_off_location_key AS third,
  trip_count AS rolled, passenger_count AS people, total_payment_amount AS amount, NULL AS labels
FROM trip_fact
UNION ALL
SELECT 'crashes', date_key, location_key, NULL, NULL, crash_count, person_injury_count,
  CAST(person_kill_count AS DOUBLE), array_to_string(list_concat(list_concat(contributing_factor_list, ['/']),
    list_concat(list_concat(impacted_participant_list, ['/']), vehicle_type_list)), '|')
FROM crash_dim
"""


@QUERIES.add(_ROLLED_SQL)
def daily_refresh_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and crashes that come in two batches: the second rebuilds only the years it touches.

    The second batch comes twice, as after a failure. Files of other years must be the same
    before and after.
    """
    roots = {name: work_path(spark, f"daily_{name}") for name in ("trips", "crashes")}
    trips, crashes = inputs.raw_trips(spark, sf_dir), inputs.raw_crashes(spark, sf_dir)
    polygons = inputs.zone_polygons(spark, sf_dir)
    late_trips = (F.year("tpep_pickup_datetime") == 1996) & (F.col("passenger_count") > 20)
    late_crashes = F.col("CRASH DATE").rlike("^0[1-3]/.*/1996$") & (F.col("NUMBER OF PERSONS INJURED") != "0")

    def files(name: str) -> set:
        stored = spark.read.parquet(f"{roots[name]}/table")
        return {tuple(r) for r in stored.select("_period", "_metadata.file_path").distinct().collect()}

    merge = {
        "trips": lambda rows, batch: daily.merge_trips(rows, roots["trips"], batch, "year"),
        "crashes": lambda rows, batch: daily.merge_crashes(rows, polygons, roots["crashes"], batch, "year"),
    }
    for name, rows, late in (("trips", trips, late_trips), ("crashes", crashes, late_crashes)):
        late = F.coalesce(late, F.lit(False))
        merge[name](rows.where(~late), 0)
        before = files(name)
        for _ in range(2):
            touched = set(merge[name](rows.where(late), 1))
        kept = {f for f in before if f[0] not in touched}
        if kept != {f for f in files(name) if f[0] not in touched}:
            raise RuntimeError(f"{name}: a file of an untouched year changed")
    long = lambda c: F.col(c).cast("bigint") if c else F.lit(None).cast("bigint")

    def rows_of(table: DataFrame, name: str, keys: tuple, counted: tuple, labels: object) -> DataFrame:
        return table.select(
            F.lit(name).alias("loaded"), long("date_key").alias("date_key"),
            *[long(k).alias(n) for k, n in zip(keys, ("first", "second", "third"), strict=True)],
            long(counted[0]).alias("rolled"), long(counted[1]).alias("people"),
            F.col(counted[2]).cast("double").alias("amount"), labels.alias("labels"),
        )

    lists = F.concat(
        "contributing_factor_list", F.array(F.lit("/")), "impacted_participant_list", F.array(F.lit("/")), "vehicle_type_list"
    )
    return rows_of(
        daily.trip_table(spark, roots["trips"]), "trips",
        ("vendor_key", "pickup_location_key", "drop_off_location_key"),
        ("trip_count", "passenger_count", "total_payment_amount"), F.lit(None).cast("string"),
    ).unionByName(
        rows_of(
            daily.crash_table(spark, roots["crashes"]), "crashes", ("location_key", None, None),
            ("crash_count", "person_injury_count", "person_kill_count"), F.array_join(lists, "|"),
        )
    )
