"""Music star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import inputs
from starloom.catalog.base import Registry, table
from starloom.functions.dates import epoch_ms_to_timestamp, timestamp_to_epoch_ms
from starloom.operators.joins import insert_new
from starloom.operators.surrogate import dense_id, row_id
from starloom.plans import music

QUERIES = Registry()

_SECONDS = "strftime(make_timestamp(ts // 1000 * 1000000), '%Y-%m-%d %H:%M:%S')"

# ---- dimensions ------------------------------------------------------------------

_SONG_COLUMNS = "song_id, title, artist_id, CAST(year AS BIGINT) AS year, duration"


@QUERIES.add(f"WITH {inputs.SONGS_SQL} SELECT DISTINCT {_SONG_COLUMNS} FROM songs")
def songs_dim_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.songs_dim(inputs.songs(spark, sf_dir))


@QUERIES.add(f"""
WITH {inputs.SONGS_SQL}
SELECT {_SONG_COLUMNS} FROM songs QUALIFY 1 = row_number() OVER (
  PARTITION BY song_id ORDER BY title NULLS FIRST, artist_id NULLS FIRST, year NULLS FIRST, duration NULLS FIRST)
""")
def songs_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.songs_dim(inputs.songs(spark, sf_dir), "one_per_key")


_ARTIST_COLUMNS = """artist_id, artist_name AS name, artist_location AS location,
  CAST(artist_latitude AS DOUBLE) AS latitude, CAST(artist_longitude AS DOUBLE) AS longitude"""


@QUERIES.add(f"WITH {inputs.SONGS_SQL} SELECT DISTINCT {_ARTIST_COLUMNS} FROM songs")
def artists_dim_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.artists_dim(inputs.songs(spark, sf_dir))


@QUERIES.add(f"""
WITH {inputs.SONGS_SQL}
SELECT {_ARTIST_COLUMNS} FROM songs QUALIFY 1 = row_number() OVER (
  PARTITION BY artist_id ORDER BY artist_name NULLS FIRST, artist_location NULLS FIRST,
               artist_latitude NULLS FIRST, artist_longitude NULLS FIRST)
""")
def artists_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.artists_dim(inputs.songs(spark, sf_dir), "one_per_key")


_USER_COLUMNS = '"userId" AS user_id, "firstName" AS first_name, "lastName" AS last_name, gender, level'


@QUERIES.add(
    f"WITH {inputs.EVENTS_SQL} SELECT DISTINCT {_USER_COLUMNS} FROM log WHERE page = 'NextSong'"
)
def users_dim_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.users_dim(inputs.events(spark, sf_dir))


@QUERIES.add(f"""
WITH {inputs.EVENTS_SQL}
SELECT {_USER_COLUMNS} FROM log WHERE page = 'NextSong' QUALIFY 1 = row_number() OVER (
  PARTITION BY "userId", level ORDER BY "firstName" NULLS FIRST, "lastName" NULLS FIRST, gender NULLS FIRST)
""")
def users_dim_per_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.users_dim(inputs.events(spark, sf_dir), "per_level")


@QUERIES.add(f"""
WITH {inputs.EVENTS_SQL}
SELECT {_USER_COLUMNS} FROM log WHERE page = 'NextSong' QUALIFY 1 = row_number() OVER (
  PARTITION BY "userId" ORDER BY ts DESC NULLS LAST, "firstName" DESC NULLS LAST,
               "lastName" DESC NULLS LAST, gender DESC NULLS LAST, level DESC NULLS LAST)
""")
def users_dim_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.users_dim(inputs.events(spark, sf_dir), "latest")


def _time_sql(where: str, weekday: str) -> str:
    return f"""
WITH {inputs.EVENTS_SQL},
times AS (SELECT DISTINCT make_timestamp(ts // 1000 * 1000000) AS t FROM log {where})
SELECT strftime(t, '%Y-%m-%d %H:%M:%S') AS start_time, CAST(hour(t) AS BIGINT) AS hour,
       CAST(day(t) AS BIGINT) AS day, CAST(week(t) AS BIGINT) AS week,
       CAST(month(t) AS BIGINT) AS month, CAST(year(t) AS BIGINT) AS year,
       CAST(dayofweek(t) + {weekday} AS BIGINT) AS weekday
FROM times"""


@QUERIES.add(_time_sql("", "0"))
def time_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.time_dim(inputs.events(spark, sf_dir))


@QUERIES.add(_time_sql("WHERE page = 'NextSong'", "1"))
def time_dim_of_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of plays only, Sunday numbered 1."""
    return music.time_dim(inputs.events(spark, sf_dir), plays_only=True, weekday_base=1)


@QUERIES.add("""
SELECT event_id, epoch_us(ts) // 1000 AS epoch_ms,
       strftime(make_timestamp(epoch_us(ts) // 1000000 * 1000000), '%Y-%m-%d %H:%M:%S') AS whole_second,
       epoch_us(ts) // 1000 % 1000 AS milliseconds
FROM events
""")
def epoch_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = table(spark, sf_dir, "events").select(
        "event_id", timestamp_to_epoch_ms(F.col("ts")).alias("epoch_ms")
    )
    exact = epoch_ms_to_timestamp(F.col("epoch_ms"), whole_seconds=False)
    return millis.select(
        "event_id",
        "epoch_ms",
        epoch_ms_to_timestamp(F.col("epoch_ms")).alias("whole_second"),
        (timestamp_to_epoch_ms(exact) % 1000).alias("milliseconds"),
    )


# ---- fact ------------------------------------------------------------------------

_FACT = f"""{_SECONDS} AS start_time, "userId" AS user_id, level, song_id, artist_id,
  "sessionId" AS session_id, location, "userAgent" AS user_agent"""
_CTES = f"""WITH {inputs.EVENTS_SQL}, {inputs.SONGS_SQL},
one_song AS (SELECT * FROM songs QUALIFY 1 = row_number() OVER (
  PARTITION BY song_id ORDER BY artist_id, title, artist_name, duration))"""


@QUERIES.add(f"""
{_CTES} SELECT DISTINCT {_FACT} FROM log, songs WHERE page = 'NextSong' AND song = title
""")
def songplays_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.songplays(
        inputs.events(spark, sf_dir), inputs.songs(spark, sf_dir), ["title"], distinct=True, key=None
    )


@QUERIES.add(f"""
{_CTES} SELECT {_FACT} FROM log JOIN one_song ON artist = artist_name AND song = title
WHERE page = 'NextSong'
""")
def songplays_by_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.songplays(inputs.events(spark, sf_dir), inputs.songs(spark, sf_dir), key=None)


@QUERIES.add(f"""
{_CTES} SELECT {_FACT}, md5("sessionId" || {_SECONDS}) AS songplay_id
FROM (SELECT * FROM log WHERE page = 'NextSong')
LEFT JOIN one_song ON song = title AND artist = artist_name AND round(length) = round(duration)
""")
def songplays_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All plays, with the song where title, artist and whole seconds agree; md5 key."""
    return music.songplays(
        inputs.events(spark, sf_dir),
        inputs.songs(spark, sf_dir),
        ["title", "artist_name", "duration"],
        how="left",
        duration_scale=0,
    )


_LOADED_SQL = "SELECT c_custkey AS user_id, c_custkey * 100 + 1 + c_nationkey AS session_id FROM customer"


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions loaded earlier: one per customer."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        (F.col("c_custkey") * 100 + 1 + F.col("c_nationkey")).alias("session_id"),
    )


@QUERIES.add(f"""
{_CTES}, loaded AS ({_LOADED_SQL})
SELECT DISTINCT {_FACT} FROM (
  SELECT log.* FROM log WHERE page = 'NextSong' AND NOT EXISTS (
    FROM loaded WHERE (loaded.user_id, loaded.session_id) = (log."userId", log."sessionId"))
) JOIN one_song ON (title, artist_name) = (song, artist)
""")
def songplays_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.songplays(
        inputs.events(spark, sf_dir),
        inputs.songs(spark, sf_dir),
        existing=_loaded(spark, sf_dir),
        distinct=True,
        key=None,
    )


_FACT_ORDER = ", ".join(
    f"{c} NULLS FIRST"
    for c in (
        "start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent",
    )
)


@QUERIES.add(f"""
{_CTES}, fact AS (
  SELECT DISTINCT {_FACT} FROM log JOIN songs ON artist = artist_name AND song = title
  WHERE page = 'NextSong'
)
SELECT *, row_number() OVER (ORDER BY {_FACT_ORDER}) - 1 AS songplay_id FROM fact
""")
def songplays_dense_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.songplays(
        inputs.events(spark, sf_dir), inputs.songs(spark, sf_dir), distinct=True, key="dense"
    )


@QUERIES.add("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS order_id FROM orders")
def dense_id_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_id(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], "order_id")


@QUERIES.add("SELECT count(*) AS row_count, count(*) AS id_count FROM lineitem")
def row_id_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row ids are unique: as many ids as rows."""
    ids = row_id(table(spark, sf_dir, "lineitem").select("l_orderkey"), "id")
    return ids.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("id_count")
    )


@QUERIES.add(f"""
WITH {inputs.EVENTS_SQL}
SELECT DISTINCT {_USER_COLUMNS} FROM log
WHERE page = 'NextSong' AND "userId" NOT IN (SELECT DISTINCT s_suppkey FROM supplier)
""")
def users_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users the target (supplier keys) does not hold yet."""
    return insert_new(
        music.users_dim(inputs.events(spark, sf_dir)),
        table(spark, sf_dir, "supplier"),
        ["user_id"],
        null_aware=True,
        target_keys=["s_suppkey"],
    )


@QUERIES.add("""
WITH incoming AS (SELECT event_id, nullif(user_id, 7) AS id FROM events)
SELECT 'target' AS target, event_id, id FROM incoming
WHERE id NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'target with NULL', event_id, id FROM incoming
WHERE id NOT IN (SELECT nullif(s_suppkey, 3) FROM supplier)
UNION ALL SELECT 'empty target', event_id, id FROM incoming
WHERE id NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey < 0)
""")
def insert_new_null_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT IN with NULLs among the incoming keys, for three kinds of target."""
    key = F.col("s_suppkey")
    incoming = table(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("user_id"), F.lit(7)).alias("id")
    )
    supplier = table(spark, sf_dir, "supplier")
    targets = {
        "target": supplier.select(key.alias("id")),
        "target with NULL": supplier.select(F.nullif(key, F.lit(3)).alias("id")),
        "empty target": supplier.where(key < 0).select(key.alias("id")),
    }
    parts = [
        insert_new(incoming, t, ["id"], null_aware=True).select(F.lit(n).alias("target"), "event_id", "id")
        for n, t in targets.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---- reports ---------------------------------------------------------------------

_PLAYS_BY_ARTIST = f"""
fact AS (SELECT song_id, artist_id FROM log JOIN one_song ON artist = artist_name AND song = title
         WHERE page = 'NextSong')"""


@QUERIES.add(f"""
{_CTES}, {_PLAYS_BY_ARTIST}
SELECT s.title, count(*) AS play_count FROM fact sp JOIN songs s ON sp.artist_id = s.artist_id
GROUP BY s.title ORDER BY play_count DESC, s.title LIMIT 10
""")
def top_songs_by_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As often as the artist was played: each title of an artist gets all its plays."""
    songs = inputs.songs(spark, sf_dir)
    fact = music.songplays(inputs.events(spark, sf_dir), songs, key=None)
    return music.top_songs(fact, songs)


@QUERIES.add(f"""
{_CTES}, {_PLAYS_BY_ARTIST}, dim AS (SELECT DISTINCT song_id, title FROM songs)
SELECT s.title, count(*) AS play_count FROM fact sp JOIN dim s ON sp.song_id = s.song_id
GROUP BY s.title ORDER BY play_count DESC, s.title LIMIT 10
""")
def top_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    songs = inputs.songs(spark, sf_dir)
    fact = music.songplays(inputs.events(spark, sf_dir), songs, key=None)
    return music.top_songs(fact, music.songs_dim(songs, "one_per_key"), on="song_id")
