"""Full refreshes in dependency order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.operators.keyed import dedupe_by_key
from starloom.operators.quality import CheckSpec, run_checks
from starloom.operators.sinks import (
    insert_new_rows,
    load_dimension,
    load_fact,
    materialize,
    overwrite_table,
    stage_table,
    write_parquet,
)
from starloom.plans import city, music
from starloom.plans.model import create_model
from starloom.schemas import STAGING_EVENTS, STAGING_SONGS
from starloom.session import shared_dir
from starloom.sources.files import read_csv_strings
from starloom.sources.geo import read_zone_polygons
from starloom.sources.staging import stage_json
from starloom.streaming.incremental import stage_incremental


def _qualified(database: str | None, table: str) -> str:
    return f"{database}.{table}" if database else table


def run_music_pipeline(
    spark: SparkSession,
    log_path: str,
    song_path: str,
    database: str | None = None,
    log_paths: Mapping[str, str] | None = None,
    location: str | None = None,
    once_per_file: bool = True,
    dimensions: str = "insert_new",
    match_on: Sequence[str] = ("title", "artist_name", "duration"),
) -> DataFrame:
    """Stage → songplays → dimensions → quality checks; returns the check report.

    Files are staged once each into folders under ``location``: a run takes what is new
    and keeps what earlier runs staged. With ``once_per_file`` off, all given files are
    appended to the staging tables. Either way the fact takes every play that it does not
    hold yet, known by all of its columns (``PLAY_IDENTITY``): a session may go on in later
    runs, plays of one millisecond stay apart, and a repeated run adds nothing, also of plays
    without a session. Dimensions get rows of new keys (``insert_new``), or are rebuilt
    from all staged rows (``replace``). :func:`starloom.streaming.refresh.refresh_music_by_batch`
    does the same without reading what was staged before.
    """
    create_model(spark, "music", database, location=location)

    def table(name: str) -> str:
        return _qualified(database, name)

    if once_per_file:
        base = location or f"{shared_dir(spark)}/starloom/music-{database or 'default'}"
        base = f"{base.rstrip('/')}/staged"

        def staged(name: str, path: str, schema: T.StructType, paths: Mapping[str, str] | None) -> DataFrame:
            stage_incremental(spark, path, schema, f"{base}/{name}", f"{base}/_checkpoints/{name}", paths)
            return spark.read.schema(schema).parquet(f"{base}/{name}")

        events = staged("events", log_path, STAGING_EVENTS, log_paths)
        songs = staged("songs", song_path, STAGING_SONGS, None)
    else:
        stage_table(spark, log_path, table("staging_events"), log_paths)
        stage_table(spark, song_path, table("staging_songs"))
        events, songs = spark.table(table("staging_events")), spark.table(table("staging_songs"))

    fact = music.songplays(
        events,
        songs,
        match_on=match_on,
        how="left",
        existing=spark.table(table("songplays")),
        new_by=("songplay_id",),
        key="event",
        whole_seconds=False,
    )
    rest = [c for c in fact.columns if c != "songplay_id"]
    load_fact(dedupe_by_key(fact, ["songplay_id"], rest), table("songplays"))

    loads = {
        "users": (music.users_dim(events, "latest"), ["user_id"]),
        "songs": (music.songs_dim(songs, "one_per_key"), ["song_id"]),
        "artists": (music.artists_dim(songs, "one_per_key"), ["artist_id"]),
        "time": (music.time_dim(events, plays_only=True, whole_seconds=False), ["start_time"]),
    }
    for name, (rows, keys) in loads.items():
        if dimensions == "insert_new":
            insert_new_rows(rows, table(name), keys)
        elif dimensions == "replace":
            load_dimension(rows, table(name), "truncate")
        else:
            raise ValueError(f"unknown dimension load {dimensions!r}")

    return run_checks(
        spark,
        [
            CheckSpec(
                table("songplays"),
                not_null=["songplay_id", "start_time", "user_id"],
                unique=[["songplay_id"]],
            ),
            CheckSpec(table("users"), not_null=["user_id"], unique=[["user_id"]]),
            CheckSpec(table("songs"), not_null=["song_id"], unique=[["song_id"]]),
            CheckSpec(table("artists"), not_null=["artist_id"], unique=[["artist_id"]]),
            CheckSpec(table("time"), not_null=["start_time"], unique=[["start_time"]]),
        ],
    )


def run_lake_pipeline(spark: SparkSession, log_path: str, song_path: str, output: str) -> None:
    """Raw JSON → partitioned Parquet folders under ``output``.

    songs by year and artist, time and songplays by year and month, users and artists
    unpartitioned. Songs and plays are stored once in columnar form and read from there by
    the jobs that need them.
    """
    write_parquet(
        stage_json(spark, song_path, STAGING_SONGS, recursive=True), f"{output}/songs_staged"
    )
    songs = spark.read.parquet(f"{output}/songs_staged")
    write_parquet(
        music.songs_dim(songs, "one_per_key"), f"{output}/songs_table", ["year", "artist_id"]
    )
    write_parquet(music.artists_dim(songs, "one_per_key"), f"{output}/artists_table")

    write_parquet(
        music.plays(stage_json(spark, log_path, STAGING_EVENTS)), f"{output}/plays_staged"
    )
    played = spark.read.parquet(f"{output}/plays_staged")
    write_parquet(music.users_dim(played, "per_level"), f"{output}/users_table")
    times = music.time_dim(played, weekday_base=1, whole_seconds=False)
    write_parquet(times, f"{output}/time_table", ["year", "month"])
    fact = music.songplays(played, songs, key="row", whole_seconds=False)
    write_parquet(
        music.with_partition_columns(fact), f"{output}/songplays_table", ["year", "month"]
    )


def run_city_pipeline(
    spark: SparkSession,
    trips_path: str,
    crashes_path: str,
    zones_path: str,
    polygons_path: str,
    database: str | None = None,
    location: str | None = None,
    reuse_located: bool = False,
) -> DataFrame:
    """location, vendor, date, crash and trip tables; returns the check report.

    ``reuse_located`` takes the crashes located by an earlier run instead of joining
    them to the zone polygons again.
    """
    create_model(spark, "city", database, location=location)

    def table(name: str) -> str:
        return _qualified(database, name)

    raw = {
        "zones": read_csv_strings(spark, zones_path),
        "crashes": read_csv_strings(spark, crashes_path),
        "trips": read_csv_strings(spark, trips_path, multi_line=False),  # no field holds a line break: files are split
    }
    overwrite_table(city.location_dim(raw["zones"]), table("location_dim"))
    overwrite_table(city.vendor_dim(spark), table("vendor_dim"))
    overwrite_table(city.date_dim(spark), table("date_dim"))

    cache = table("crashes_located")
    if reuse_located and spark.catalog.tableExists(cache):
        located = spark.table(cache)
    else:
        polygons = read_zone_polygons(spark, polygons_path)
        located = materialize(
            city.locate_crashes(city.clean_crashes(raw["crashes"]), polygons),
            cache,
            path=f"{location.rstrip('/')}/crashes_located" if location else None,
        )
    overwrite_table(city.crash_dim(located), table("crash_dim"))
    overwrite_table(city.trip_fact(city.clean_trips(raw["trips"])), table("trip_fact"))

    return run_checks(
        spark,
        [
            CheckSpec(table("vendor_dim"), unique=[["vendor_key"]]),
            CheckSpec(table("location_dim"), unique=[["location_key"]]),
            CheckSpec(table("date_dim"), unique=[["date_key"]]),
            CheckSpec(table("crash_dim"), unique=[["date_key", "location_key"]]),
            CheckSpec(
                table("trip_fact"),
                not_null=["vendor_key"],
                references=[("vendor_key", table("vendor_dim"), "vendor_key")],
            ),
        ],
    )
