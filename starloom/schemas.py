"""Schema registry: staging inputs and model tables.

Every reader takes one of these (or a caller's own) and every writer aligns to one
by name, so a renamed or re-ordered column can never land in the wrong place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.casts import strict_cast


STRING, INT, LONG, TINY = T.StringType(), T.IntegerType(), T.LongType(), T.ByteType()
DOUBLE, TIMESTAMP, STRINGS = T.DoubleType(), T.TimestampType(), T.ArrayType(T.StringType())


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# ---- fixed values: input layouts -------------------------------------------------

STAGING_EVENTS = _schema(
    artist=STRING,
    auth=STRING,
    firstName=STRING,
    gender=STRING,
    itemInSession=INT,
    lastName=STRING,
    length=DOUBLE,
    level=STRING,
    location=STRING,
    method=STRING,
    page=STRING,
    registration=DOUBLE,
    sessionId=INT,
    song=STRING,
    status=INT,
    ts=LONG,
    userAgent=STRING,
    userId=INT,
)

STAGING_SONGS = _schema(
    num_songs=INT,
    artist_id=STRING,
    artist_latitude=DOUBLE,
    artist_longitude=DOUBLE,
    artist_location=STRING,
    artist_name=STRING,
    song_id=STRING,
    title=STRING,
    duration=DOUBLE,
    year=INT,
)

PLAY_LOG_COLUMNS = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length", "level",
    "location", "sessionId", "song", "userId",
]

# ---- fixed values: model tables --------------------------------------------------

MUSIC_MODEL = {
    "staging_events": STAGING_EVENTS,
    "staging_songs": STAGING_SONGS,
    "songplays": _schema(
        songplay_id=STRING,
        start_time=TIMESTAMP,
        user_id=INT,
        level=STRING,
        song_id=STRING,
        artist_id=STRING,
        session_id=INT,
        location=STRING,
        user_agent=STRING,
    ),
    "users": _schema(
        user_id=INT,
        first_name=STRING,
        last_name=STRING,
        gender=STRING,
        level=STRING,
    ),
    "songs": _schema(
        song_id=STRING,
        title=STRING,
        artist_id=STRING,
        year=INT,
        duration=T.DecimalType(15, 5),
    ),
    "artists": _schema(
        artist_id=STRING,
        name=STRING,
        location=STRING,
        latitude=T.DecimalType(12, 6),
        longitude=T.DecimalType(12, 6),
    ),
    "time": _schema(
        start_time=TIMESTAMP,
        hour=INT,
        day=INT,
        week=INT,
        month=INT,
        year=INT,
        weekday=INT,
    ),
}

CITY_MODEL = {
    "trip_fact": _schema(
        vendor_key=INT,
        pickup_location_key=INT,
        drop_off_location_key=INT,
        date_key=INT,
        passenger_count=LONG,
        total_payment_amount=T.DecimalType(18, 2),
        trip_count=LONG,
    ),
    "date_dim": _schema(
        date_key=INT,
        day=TINY,
        week=TINY,
        month=TINY,
        quarter=TINY,
        year=INT,
    ),
    "vendor_dim": _schema(
        vendor_key=TINY,
        name=STRING,
    ),
    "location_dim": _schema(
        location_key=INT,
        zone=STRING,
        borough=STRING,
    ),
    "crash_dim": _schema(
        date_key=INT,
        location_key=INT,
        crash_count=LONG,
        person_injury_count=LONG,
        person_kill_count=LONG,
        contributing_factor_list=STRINGS,
        impacted_participant_list=STRINGS,
        vehicle_type_list=STRINGS,
    ),
}

LOOKUP_MODEL = {
    "session_music": _schema(
        sessionId=INT,
        itemInSession=INT,
        artist=STRING,
        song=STRING,
        length=DOUBLE,
    ),
    "song_per_session": _schema(
        userId=INT,
        sessionId=INT,
        itemInSession=INT,
        artist=STRING,
        song=STRING,
        firstName=STRING,
        lastName=STRING,
    ),
    "song_listen_history": _schema(
        song=STRING,
        userId=INT,
        firstName=STRING,
        lastName=STRING,
    ),
}


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns by name (any letter case) and cast to its types.

    A column that is missing from ``df`` is an error, and so is a value that does not
    fit its type: neither becomes a silent NULL.
    """
    have = {c.lower(): c for c in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in have]
    if missing:
        raise ValueError(f"columns missing for the target table: {missing}")

    def cast(field: T.StructField) -> Column:
        source = F.col(f"`{have[field.name.lower()]}`")
        if df.schema[have[field.name.lower()]].dataType == field.dataType:
            return source.alias(field.name)
        return strict_cast(source, field.dataType, field.name).alias(field.name)

    return df.select(*[cast(f) for f in schema])
