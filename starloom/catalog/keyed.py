"""Query-shaped keyed tables, lookups and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.catalog import inputs
from starloom.catalog.base import Registry, table
from starloom.operators.keyed import lookup, upsert
from starloom.plans import music

QUERIES = Registry()


def _latest_sql(keys: str, columns: str) -> str:
    """Last write per key among plays; ties on ts go to the larger values."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["ts", *columns.split(", ")])
    return f"""
WITH {inputs.EVENTS_SQL},
latest AS (
  SELECT {keys}, {columns} FROM log WHERE artist <> ''
  QUALIFY 1 = row_number() OVER (PARTITION BY {keys} ORDER BY {order})
)"""


_SESSION_MUSIC = (
    _latest_sql('"sessionId", "itemInSession"', "artist, song, length"),
    'CAST("sessionId" AS BIGINT) AS "sessionId", CAST("itemInSession" AS BIGINT) AS "itemInSession", '
    "artist, song, length",
)
_SONG_PER_SESSION = (
    _latest_sql('"userId", "sessionId", "itemInSession"', 'artist, song, "firstName", "lastName"'),
    '"userId", "sessionId", CAST("itemInSession" AS BIGINT) AS "itemInSession", artist, song, '
    '"firstName", "lastName"',
)
_LISTEN_HISTORY = (
    _latest_sql('song, "userId"', '"firstName", "lastName"'),
    'song, "userId", "firstName", "lastName"',
)


@QUERIES.add(f"{_SESSION_MUSIC[0]} SELECT {_SESSION_MUSIC[1]} FROM latest")
def session_music(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.session_music(inputs.events(spark, sf_dir))


@QUERIES.add(f"{_SONG_PER_SESSION[0]} SELECT {_SONG_PER_SESSION[1]} FROM latest")
def song_per_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.song_per_session(inputs.events(spark, sf_dir))


@QUERIES.add(f"{_LISTEN_HISTORY[0]} SELECT {_LISTEN_HISTORY[1]} FROM latest")
def song_listen_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return music.song_listen_history(inputs.events(spark, sf_dir))


@QUERIES.add(
    f"""{_SESSION_MUSIC[0]} SELECT artist, song, length FROM latest
WHERE "sessionId" = 1018 AND "itemInSession" = 9"""
)
def session_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was played as item 9 of session 1018: lookup by full key."""
    return lookup(
        music.session_music(inputs.events(spark, sf_dir)), sessionId=1018, itemInSession=9
    ).select("artist", "song", "length")


@QUERIES.add(
    f"""{_SONG_PER_SESSION[0]} SELECT artist, song, "firstName", "lastName" FROM latest
WHERE "userId" = 10 AND "sessionId" = 1018 ORDER BY "itemInSession" """
)
def session_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs of user 10's session 1018 in play order: key prefix, ordered read."""
    return lookup(
        music.song_per_session(inputs.events(spark, sf_dir)),
        order_by=["itemInSession"],
        userId=10,
        sessionId=1018,
    ).select("artist", "song", "firstName", "lastName")


@QUERIES.add(
    f"""{_LISTEN_HISTORY[0]} SELECT "firstName", "lastName" FROM latest WHERE song = 'red widget'"""
)
def song_listeners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who listened to a song: lookup by partition key."""
    return lookup(
        music.song_listen_history(inputs.events(spark, sf_dir)), song="red widget"
    ).select("firstName", "lastName")


@QUERIES.add("""
WITH merged AS (
  SELECT c_custkey AS user_id, c_mktsegment AS status, 0 AS incoming, NULL AS event_id FROM customer
  UNION ALL SELECT user_id, event_type, 1, event_id FROM events
)
SELECT user_id, status FROM merged QUALIFY 1 = row_number() OVER (
  PARTITION BY user_id ORDER BY incoming DESC, event_id DESC NULLS LAST)
""")
def upsert_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status per customer, overwritten by the user's latest event."""
    target = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("status")
    )
    incoming = table(spark, sf_dir, "events").select(
        "user_id", F.col("event_type").alias("status"), "event_id"
    )
    return upsert(target, incoming, ["user_id"], ["event_id"])
