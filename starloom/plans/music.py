"""Music-streaming star schema and the reports on it.

Inputs are the staging tables of :mod:`starloom.schemas` (``STAGING_EVENTS``,
``STAGING_SONGS``); every job is DataFrame → DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import calendar_parts, epoch_ms_to_timestamp
from starloom.functions.keys import hash_key, row_key
from starloom.operators.joins import insert_new, skew_join
from starloom.operators.keyed import dedupe_by_key, keyed_table
from starloom.operators.ranking import top_k
from starloom.operators.surrogate import dense_id, row_id

# fixed value: the page that marks a play in the application log
PLAY_PAGE = "NextSong"


def plays(events: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    return events.where(F.col("page") == page)


# ---- dimensions ------------------------------------------------------------------


def songs_dim(songs: DataFrame, mode: str = "distinct") -> DataFrame:
    """``distinct`` rows, or ``one_per_key`` with a fixed survivor per song_id."""
    rows = songs.select("song_id", "title", "artist_id", "year", "duration")
    if mode == "distinct":
        return rows.distinct()
    return dedupe_by_key(rows, ["song_id"], ["title", "artist_id", "year", "duration"])


def artists_dim(songs: DataFrame, mode: str = "distinct") -> DataFrame:
    """``distinct`` rows, or ``one_per_key`` with a fixed survivor per artist_id."""
    rows = songs.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
    )
    if mode == "distinct":
        return rows.distinct()
    return dedupe_by_key(rows, ["artist_id"], ["name", "location", "latitude", "longitude"])


def users_dim(events: DataFrame, mode: str = "distinct", page: str = PLAY_PAGE) -> DataFrame:
    """Users seen on plays.

    ``distinct``: every combination of attributes, so a user who changed level has
    several rows. ``per_level``: one row per user and level. ``latest``: one row per
    user, as of the last play.
    """
    rows = plays(events, page).select(
        F.col("userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        "ts",
    )
    columns = ["user_id", "first_name", "last_name", "gender", "level"]
    if mode == "distinct":
        return rows.select(*columns).distinct()
    attributes = ["first_name", "last_name", "gender", "level"]
    if mode == "per_level":
        return dedupe_by_key(
            rows.select(*columns), ["user_id", "level"], ["first_name", "last_name", "gender"]
        )
    if mode == "latest":
        return keyed_table(rows, ["user_id"], ["ts", *attributes], columns)
    raise ValueError(f"unknown mode {mode!r}")


def time_dim(
    events: DataFrame,
    plays_only: bool = False,
    weekday_base: int = 0,
    whole_seconds: bool = True,
    page: str = PLAY_PAGE,
) -> DataFrame:
    """Distinct event times with their calendar parts.

    Repeats are removed on the bare time first, so the parts are computed once each.
    """
    source = plays(events, page) if plays_only else events
    times = (
        source.select(epoch_ms_to_timestamp(F.col("ts"), whole_seconds).alias("start_time"))
        .where(F.col("start_time").isNotNull())
        .distinct()
    )
    parts = calendar_parts(F.col("start_time"), weekday_base)
    return times.select("start_time", *[c.alias(n) for n, c in parts.items()])


# ---- fact ------------------------------------------------------------------------

_MATCH_COLUMNS = {"title": "song", "artist_name": "artist", "duration": "length"}
#: Log columns that make two plays one: a session may play two items in one millisecond.
PLAY_IDENTITY = (
    "sessionId", "ts", "userId", "itemInSession", "song", "artist", "length", "level", "location", "userAgent",
)


def enrich_plays(
    played: DataFrame,
    songs: DataFrame,
    match_on: Sequence[str] = ("title", "artist_name"),
    how: str = "inner",
    duration_scale: int | None = None,
    hot: DataFrame | None = None,
    one_row_per_song: bool = True,
) -> DataFrame:
    """Plays joined to song metadata on title, artist and/or duration.

    ``how="left"`` keeps plays without a song. ``duration_scale`` rounds both durations
    before they are compared (0 compares whole seconds). A song_id with several metadata
    rows counts once, with the first of them in column order; off, repeats of the same
    match are dropped and each other row matches on its own. Different songs of equal
    title and artist return one row each. ``hot`` lists match keys (``_match_*`` columns)
    whose plays are spread over many tasks; without it skew is left to AQE.
    """

    def comparable(column: Column, name: str) -> Column:
        if name == "duration" and duration_scale is not None:
            return F.round(column, duration_scale)
        return column

    keys = [f"_match_{name}" for name in match_on]
    left = played.withColumns(
        {k: comparable(F.col(_MATCH_COLUMNS[n]), n) for k, n in zip(keys, match_on, strict=True)}
    )
    if one_row_per_song:
        songs = unique_songs(songs)
    right = songs.select(
        "song_id",
        "artist_id",
        *[comparable(F.col(n), n).alias(k) for k, n in zip(keys, match_on, strict=True)],
    )
    if not one_row_per_song:
        right = right.distinct()
    if how == "inner":
        left, right = left.dropna(subset=keys), right.dropna(subset=keys)
    return skew_join(left, right, keys, how, hot).drop(*keys)


def unique_songs(songs: DataFrame) -> DataFrame:
    """One metadata row per song_id: the first in column order; rows without an id stay."""
    order = ["artist_id", "title", "artist_name", "duration"]
    kept = dedupe_by_key(songs.where(F.col("song_id").isNotNull()).select("song_id", *order), ["song_id"], order)
    return kept.unionByName(songs.where(F.col("song_id").isNull()).select("song_id", *order))


def songplays(
    events: DataFrame,
    songs: DataFrame,
    match_on: Sequence[str] = ("title", "artist_name"),
    how: str = "inner",
    duration_scale: int | None = None,
    existing: DataFrame | None = None,
    new_by: Sequence[str] = ("user_id", "session_id"),
    distinct: bool = False,
    key: str | None = "hash",
    whole_seconds: bool = True,
    page: str = PLAY_PAGE,
    hot: DataFrame | None = None,
    one_row_per_song: bool = True,
) -> DataFrame:
    """Songplays fact.

    ``existing`` holds fact rows loaded earlier: plays whose ``new_by`` values occur
    there are skipped, before the song join. ``key`` adds ``songplay_id``: ``hash`` is
    md5(session ‖ start time), ``event`` is md5 of all that tells a play (``PLAY_IDENTITY``,
    never NULL, and there before the join, so ``new_by`` may name it), ``dense`` is 0, 1, 2 … in a
    fixed order, ``row`` is unique only, None adds none.
    """
    own = [row_key(*PLAY_IDENTITY).alias("songplay_id")] if key == "event" else []
    played = plays(events, page).select(
        epoch_ms_to_timestamp(F.col("ts"), whole_seconds).alias("start_time"),
        F.col("userId").alias("user_id"),
        "level",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        *[_MATCH_COLUMNS[name] for name in match_on],
        *own,
    )
    if existing is not None:
        played = insert_new(played, existing, new_by)
    fact = enrich_plays(
        played, songs, match_on, how, duration_scale, hot, one_row_per_song
    ).select(
        "start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent",
        *(["songplay_id"] if own else []),
    )
    if distinct:
        fact = fact.distinct()
    if key == "hash":
        fact = fact.withColumn("songplay_id", hash_key(F.col("session_id"), F.col("start_time")))
    elif key == "dense":
        fact = dense_id(fact, fact.columns, "songplay_id")
    elif key == "row":
        fact = row_id(fact, "songplay_id")
    elif key not in (None, "event"):
        raise ValueError(f"unknown key {key!r}")
    return fact


def with_partition_columns(df: DataFrame, time_column: str = "start_time") -> DataFrame:
    """Add ``year`` and ``month`` for a partitioned write."""
    return df.withColumns({"year": F.year(time_column), "month": F.month(time_column)})


# ---- keyed lookup tables ---------------------------------------------------------


def play_rows(log: DataFrame) -> DataFrame:
    """Log rows that name an artist; an empty field and NULL both mean "no play"."""
    return log.where(F.col("artist").isNotNull() & (F.col("artist") != ""))


def session_music(log: DataFrame, order_by: Sequence[str] = ("ts",)) -> DataFrame:
    """Key (sessionId, itemInSession)."""
    return keyed_table(
        play_rows(log),
        ["sessionId", "itemInSession"],
        [*order_by, "artist", "song", "length"],
        ["sessionId", "itemInSession", "artist", "song", "length"],
    )


def song_per_session(log: DataFrame, order_by: Sequence[str] = ("ts",)) -> DataFrame:
    """Key ((userId, sessionId), itemInSession)."""
    return keyed_table(
        play_rows(log),
        ["userId", "sessionId", "itemInSession"],
        [*order_by, "artist", "song", "firstName", "lastName"],
        ["userId", "sessionId", "itemInSession", "artist", "song", "firstName", "lastName"],
    )


def song_listen_history(log: DataFrame, order_by: Sequence[str] = ("ts",)) -> DataFrame:
    """Key (song, userId)."""
    return keyed_table(
        play_rows(log),
        ["song", "userId"],
        [*order_by, "firstName", "lastName"],
        ["song", "userId", "firstName", "lastName"],
    )


# ---- reports ---------------------------------------------------------------------


def top_songs(
    fact: DataFrame, songs: DataFrame, on: str = "artist_id", k: int = 10
) -> DataFrame:
    """Titles by number of matching fact rows.

    On ``artist_id`` every title of an artist is credited with all the artist's plays; on
    ``song_id`` a title gets its own. The plays are counted per key before the join, so
    the pairs are never built: joining counts gives the same sums.
    """
    per_key = fact.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_plays"))
    titles = songs.groupBy(on, "title").agg(F.count(F.lit(1)).alias("_songs"))
    counted = (
        titles.join(per_key, on)
        .groupBy("title")
        .agg(F.sum(F.col("_songs") * F.col("_plays")).alias("play_count"))
    )
    return top_k(counted, "play_count", k, ["title"])
