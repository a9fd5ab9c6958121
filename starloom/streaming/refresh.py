"""Refresh by new files only: each micro-batch is loaded, checked and published once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.joins import insert_new
from starloom.operators.keyed import dedupe_by_key
from starloom.operators.publish import Manifest, current, publish_batch, read_published, write_pending
from starloom.operators.quality import CheckSpec
from starloom.plans import music
from starloom.schemas import MUSIC_MODEL, STAGING_EVENTS, STAGING_SONGS
from starloom.sources.staging import stage_json_text


def each_batch(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    checkpoint: str,
    load: Callable[[DataFrame, int], None],
    paths: Mapping[str, str] | None = None,
    max_files_per_batch: int | None = None,
) -> None:
    """``load(rows, number)`` for each batch of files not seen before; JSON staged into ``schema``.

    Drains what is there and ends. A batch whose load fails is given again, with the same
    files and number, by the next call; the error of the load is raised as it is.
    """
    reader = spark.readStream.format("text")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    lines = reader.load(path).where(F.length(F.trim("value")) > 0)
    failures: list[Exception] = []

    def guarded(rows: DataFrame, number: int) -> None:
        try:
            load(rows, number)
        except Exception as error:
            failures.append(error)
            raise

    query = (
        stage_json_text(lines, "value", schema, paths)
        .writeStream.foreachBatch(guarded)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if failures:
            raise failures[0] from None
        raise


def refresh_music_by_batch(
    spark: SparkSession,
    log_path: str,
    song_path: str,
    root: str,
    match_on: Sequence[str] = ("title", "artist_name", "duration"),
    log_paths: Mapping[str, str] | None = None,
    max_files_per_batch: int | None = None,
) -> list[DataFrame]:
    """New song files, then new log files → published music tables under ``root``.

    A batch is read once, from its files. Of what was loaded before, it meets the songs, the keys of
    the small dimensions, and plays and times between its own first and last time only. A play
    is known by all of its columns (``PLAY_IDENTITY``): one that came in an earlier file
    is not added again. Rows are checked before they are published; an error leaves
    all tables as they were, and the next run takes the same files again. A run
    without new files reads the manifest alone. Returns the reports of the batches.
    """
    reports: list[DataFrame] = []

    def published(like: DataFrame, name: str, manifest: Manifest) -> DataFrame:
        # read in the session that the batch runs in
        return read_published(like.sparkSession, root, name, MUSIC_MODEL[name], manifest)

    def pending(rows: DataFrame, name: str, stream: str, batch: int) -> DataFrame:
        return write_pending(rows, root, name, MUSIC_MODEL[name], stream, batch)

    def finish(manifest: Manifest, stream: str, batch: int, rows: Mapping[str, DataFrame], specs: list[CheckSpec]) -> None:
        session = next(iter(rows.values())).sparkSession
        _, report = publish_batch(session, root, manifest, stream, batch, rows, specs)
        reports.append(report)

    def load_songs(rows: DataFrame, batch: int) -> None:
        manifest = current(spark, root)
        if batch <= manifest.batches.get("songs", -1):
            return
        staged = pending(rows, "staging_songs", "songs", batch)
        loads = {
            "songs": (music.songs_dim(staged, "one_per_key"), "song_id"),
            "artists": (music.artists_dim(staged, "one_per_key"), "artist_id"),
        }
        out = {"staging_songs": staged}
        for name, (found, key) in loads.items():
            out[name] = pending(insert_new(found, published(rows, name, manifest), [key]), name, "songs", batch)
        specs = [_keyed(name, key, manifest) for name, (_, key) in loads.items()]
        finish(manifest, "songs", batch, out, specs)

    def load_events(rows: DataFrame, batch: int) -> None:
        manifest = current(spark, root)
        if batch <= manifest.batches.get("events", -1):
            return
        staged = pending(rows, "staging_events", "events", batch)
        fact = music.songplays(
            staged, published(rows, "staging_songs", manifest), match_on, "left", key="event", whole_seconds=False
        )
        fact = dedupe_by_key(fact, ["songplay_id"], [c for c in fact.columns if c != "songplay_id"])
        span = music.plays(staged).agg(
            F.timestamp_millis(F.min("ts")).alias("low"), F.timestamp_millis(F.max("ts")).alias("high")
        ).first()

        def near(name: str) -> DataFrame:
            # equal keys have equal times, so the files of other times hold none of them
            return published(rows, name, manifest).where(F.col("start_time").between(span["low"], span["high"]))

        plays = pending(insert_new(fact, near("songplays"), ["songplay_id"]), "songplays", "events", batch)
        users = insert_new(music.users_dim(staged, "latest"), published(rows, "users", manifest), ["user_id"])
        times = music.time_dim(staged, plays_only=True, whole_seconds=False)
        out = {
            "staging_events": staged,
            "songplays": plays,
            "users": pending(users, "users", "events", batch),
            "time": pending(insert_new(times, near("time"), ["start_time"]), "time", "events", batch),
        }
        specs = [
            _keyed("songplays", "songplay_id", manifest, "start_time", "user_id"),
            _keyed("users", "user_id", manifest),
            _keyed("time", "start_time", manifest),
        ]
        finish(manifest, "events", batch, out, specs)

    each_batch(spark, song_path, STAGING_SONGS, f"{root}/streams/songs", load_songs, None, max_files_per_batch)
    each_batch(spark, log_path, STAGING_EVENTS, f"{root}/streams/events", load_events, log_paths, max_files_per_batch)
    return reports


def _keyed(name: str, key: str, manifest: Manifest, *required: str) -> CheckSpec:
    """Key set and unique; only the first rows of a table must not be none."""
    return CheckSpec(name, not_null=[key, *required], unique=[[key]], may_be_empty=name in manifest.folders)
