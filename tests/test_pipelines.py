import json

import pytest
from pyspark.sql import functions as F

from starloom.operators import DataQualityError, overwrite_table
from starloom.plans import city, music
from starloom.plans.pipelines import run_city_pipeline, run_lake_pipeline, run_music_pipeline

EVENT = {
    "artist": "Muse", "auth": "Logged In", "firstName": "Ann", "gender": "F", "itemInSession": 0,
    "lastName": "Lee", "length": 200.4, "level": "free", "location": "NY", "method": "PUT",
    "page": "NextSong", "registration": 1.54e12, "sessionId": 10, "song": "Uprising", "status": 200,
    "ts": 1541121934796, "userAgent": "UA", "userId": "8",
}
SONG = {
    "num_songs": 1, "artist_id": "A1", "artist_latitude": None, "artist_longitude": 1.5,
    "artist_location": "UK", "artist_name": "Muse", "song_id": "S1", "title": "Uprising",
    "duration": 200.4, "year": 2009,
}


@pytest.fixture
def music_files(tmp_path):
    logs, songs = tmp_path / "log", tmp_path / "song"
    (songs / "A" / "B" / "C").mkdir(parents=True)
    logs.mkdir()
    events = [
        EVENT,
        {**EVENT, "ts": EVENT["ts"] + 100, "itemInSession": 1, "song": "Unknown", "level": "paid"},
        {**EVENT, "ts": EVENT["ts"] + 5000, "itemInSession": 2, "userId": "9", "firstName": "Bo", "sessionId": 11},
        {**EVENT, "page": "Home", "artist": None, "song": None, "length": None, "userId": ""},
    ]
    (logs / "1.json").write_text("\n".join(map(json.dumps, events)))
    more = [SONG, {**SONG, "artist_id": "A2", "song_id": "S2", "artist_name": "Queen", "title": "Uprising"}]
    for i, s in enumerate(more):
        (songs / "A" / "B" / "C" / f"{i}.json").write_text(json.dumps(s))
    return logs, songs


def test_music_pipeline_and_repeat(spark, music_files, tmp_path, rows):
    logs, songs = music_files
    spark.sql("DROP DATABASE IF EXISTS music_db CASCADE")
    for _ in range(2):  # the second run must add nothing
        report = run_music_pipeline(
            spark, str(logs), f"{songs}/*/*/*/*.json", "music_db", location=str(tmp_path / "wh")
        )
        assert all(r["passed"] for r in report.collect())
        fact = spark.table("music_db.songplays")
        assert rows(fact.select("user_id", "session_id", "song_id", "level")) == [
            (8, 10, None, "paid"),
            (8, 10, "S1", "free"),
            (9, 11, "S1", "free"),
        ]
    assert rows(spark.table("music_db.users").select("user_id", "level")) == [(8, "paid"), (9, "free")]
    assert spark.table("music_db.songs").count() == 2
    assert spark.table("music_db.artists").count() == 2
    assert rows(spark.table("music_db.time").select("hour", "weekday")) == [(1, 5)] * 3
    assert str(spark.table("music_db.songs").first()["duration"]) == "200.40000"
    spark.sql("DROP DATABASE music_db CASCADE")


@pytest.mark.parametrize("once_per_file", [True, False])
def test_music_pipeline_takes_a_second_batch(spark, music_files, tmp_path, rows, once_per_file):
    """The session goes on and new dimension rows come; what was loaded stays."""
    logs, songs = music_files
    spark.sql("DROP DATABASE IF EXISTS music_db3 CASCADE")

    def run():
        return run_music_pipeline(
            spark, str(logs), f"{songs}/*/*/*/*.json", "music_db3",
            location=str(tmp_path / "wh"), once_per_file=once_per_file,
        )

    run()
    later = [
        {**EVENT, "ts": EVENT["ts"] + 60_000, "itemInSession": 3, "song": "Later", "artist": "New"},
        {**EVENT, "userId": "20", "firstName": "Cy", "sessionId": 50, "ts": EVENT["ts"] + 90_000},
    ]
    if not once_per_file:
        (logs / "1.json").unlink()
    (logs / "2.json").write_text("\n".join(map(json.dumps, later)))
    (songs / "A" / "B" / "C" / "9.json").write_text(
        json.dumps({**SONG, "song_id": "S9", "artist_id": "A9", "artist_name": "New", "title": "Later"})
    )
    assert all(r["passed"] for r in run().collect())
    fact = spark.table("music_db3.songplays")
    assert rows(fact.select("user_id", "session_id", "song_id")) == [
        (20, 50, "S1"), (8, 10, None), (8, 10, "S1"), (8, 10, "S9"), (9, 11, "S1"),
    ]
    assert rows(spark.table("music_db3.users").select("user_id")) == [(20,), (8,), (9,)]
    assert spark.table("music_db3.songs").count() == 3
    assert spark.table("music_db3.time").count() == 5
    spark.sql("DROP DATABASE music_db3 CASCADE")


def test_load_fails_on_a_value_that_does_not_fit(spark):
    spark.sql("DROP TABLE IF EXISTS narrow")
    spark.sql("CREATE TABLE narrow (a int, b string) USING parquet")
    overwrite_table(spark.createDataFrame([(7, None), (None, "x")], "a long, b string"), "narrow")
    assert spark.table("narrow").count() == 2
    with pytest.raises(Exception, match="column a: no int: 5000000000"):
        overwrite_table(spark.createDataFrame([(5_000_000_000, "y")], "a long, b string"), "narrow")
    spark.sql("DROP TABLE narrow")


def test_music_pipeline_fails_on_empty_log(spark, music_files, tmp_path):
    _, songs = music_files
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "0.json").write_text("")
    spark.sql("DROP DATABASE IF EXISTS music_db2 CASCADE")
    with pytest.raises(DataQualityError, match="songplays: not_empty"):
        run_music_pipeline(
            spark, str(tmp_path / "none"), f"{songs}/*/*/*/*.json", "music_db2", location=str(tmp_path / "wh2")
        )
    spark.sql("DROP DATABASE music_db2 CASCADE")


def test_lake_pipeline(spark, music_files, tmp_path, rows):
    logs, songs = music_files
    out = str(tmp_path / "lake")
    run_lake_pipeline(spark, str(logs), str(songs), out)
    fact = spark.read.parquet(f"{out}/songplays_table")
    assert rows(fact.select("user_id", "song_id", "year", "month")) == [(8, "S1", 2018, 11), (9, "S1", 2018, 11)]
    assert fact.select("songplay_id").distinct().count() == 2
    assert rows(spark.read.parquet(f"{out}/users_table").select("user_id", "level")) == [
        (8, "free"), (8, "paid"), (9, "free"),
    ]
    songs_table = spark.read.parquet(f"{out}/songs_table")
    assert rows(songs_table.select("song_id", "year", "artist_id")) == [("S1", 2009, "A1"), ("S2", 2009, "A2")]
    times = spark.read.parquet(f"{out}/time_table")
    assert times.count() == 3 and {r["weekday"] for r in times.collect()} == {6}


TRIP_HEADER = (
    "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,PULocationID,DOLocationID,total_amount"
)
TRIPS = """1,2019-04-29 06:56:05,2019-04-29 07:00:00,1,1,2,9,,
2,2019-04-29 10:50:18,2019-04-29 10:55:00,5,1,1,8.16,,
,2019-04-29 10:50:18,2019-04-29 10:55:00,2,2,1,1.5,,
1,2019-04-29 23:59:59,2019-04-30 00:05:00,3,1,2,0.5,,
2,2019-04-30 10:50:18,2019-04-30 10:55:00,1,2,2,3,,
"""
CRASH_COLUMNS = [
    "CRASH DATE", "LATITUDE", "LONGITUDE", *city.CASUALTY_COLUMNS.values(), *city.FACTOR_COLUMNS,
    "COLLISION_ID", *city.VEHICLE_COLUMNS,
]


def crash(date, lat, lon, injured, factors, vehicles, number):
    casualties = [str(injured), "0", "0", "0", "0", "0", str(injured), "0"]
    pad = lambda v: [*v, *[""] * (5 - len(v))]
    return ",".join([date, lat, lon, *casualties, *pad(factors), number, *pad(vehicles)])


CRASHES = [
    crash("04/29/2019", "0.5", "0.5", 1, ["Unsafe Speed", "unspecified"], ["Taxi", "Sedan"], "1"),
    crash("04/29/2019", "0.6", "0.6", 0, ["Unspecified"], ["Bus"], "2"),
    crash("04/29/2019", "0.5", "2.5", 2, ["Backing Unsafely"], ["TAXI"], "3"),
    crash("04/30/2019", "0.5", "2.5", 0, ["Glare"], ["taxi"], "4"),
    crash("04/30/2019", "50", "50", 0, ["Glare"], ["taxi"], "5"),
    crash("04/30/2019", "", "2.5", 9, ["Glare"], ["taxi"], "6"),
    crash("", "0.5", "2.5", 9, ["Glare"], ["taxi"], "7"),
    crash("04/30/2019", "0.5", "2.5", 9, ["Glare"], ["taxi"], ""),
]


@pytest.fixture
def city_files(tmp_path):
    from tests.test_spatial import COLLECTION

    (tmp_path / "trips_2019-04.csv").write_text(f"{TRIP_HEADER}\n{TRIPS}")
    (tmp_path / "crashes.csv").write_text("\n".join([",".join(CRASH_COLUMNS), *CRASHES]) + "\n")
    (tmp_path / "zones.csv").write_text(
        '"LocationID","Borough","Zone","service_zone"\n1,"B","Z1","x"\n2,"B","Z2","x"\n265,"Unknown","NA","N/A"\n'
    )
    (tmp_path / "zones.geojson").write_text(json.dumps(COLLECTION))
    return tmp_path


def test_city_pipeline(spark, city_files, rows):
    def run(**options):
        report = run_city_pipeline(
            spark, f"{city_files}/trips_2019-*.csv", f"{city_files}/crashes.csv", f"{city_files}/zones.csv",
            f"{city_files}/zones.geojson", "taxi_db", location=f"{city_files}/wh", **options,
        )
        assert all(r["passed"] for r in report.collect())

    spark.sql("DROP DATABASE IF EXISTS taxi_db CASCADE")
    run()
    t = {n: spark.table(f"taxi_db.{n}") for n in ("trip_fact", "vendor_dim", "date_dim", "location_dim", "crash_dim")}
    fact_columns = "vendor_key date_key pickup_location_key drop_off_location_key passenger_count total_payment_amount trip_count"
    assert [tuple(map(str, r)) for r in rows(t["trip_fact"].select(*fact_columns.split()))] == [
        ("-1", "20190429", "2", "1", "2", "1.50", "1"),
        ("1", "20190429", "1", "2", "4", "9.50", "2"),
        ("2", "20190429", "1", "1", "5", "8.16", "1"),
        ("2", "20190430", "2", "2", "1", "3.00", "1"),
    ]
    dates = t["date_dim"].agg(F.count("*"), F.min("date_key"), F.max("date_key")).first()
    assert tuple(dates) == (10000, 20140101, 20410518)
    lists = "contributing_factor_list vehicle_type_list impacted_participant_list".split()
    assert rows(t["crash_dim"].select("date_key", "location_key", "crash_count", "person_injury_count", *lists)) == [
        (20190429, 1, 2, 1, ["UNSAFE SPEED", "UNSPECIFIED"], ["BUS", "SEDAN", "TAXI"], ["Motorist"]),
        (20190429, 2, 1, 2, ["BACKING UNSAFELY"], ["TAXI"], ["Motorist"]),
        (20190430, None, 1, 0, ["GLARE"], ["TAXI"], []),
        (20190430, 2, 1, 0, ["GLARE"], ["TAXI"], []),
    ]
    star = (t["trip_fact"], t["vendor_dim"], t["date_dim"], t["location_dim"], t["crash_dim"])
    assert rows(city.vendor_crash_count(*star)) == [
        ("Creative Mobile Technologies", 3), ("Not Available", 3), ("VeriFone Inc.", 3),
    ]
    assert city.count_crashes_with(t["crash_dim"]).first()[0] == 4
    for view, df in zip(("t", "v", "d", "l", "c"), star, strict=True):
        df.createOrReplaceTempView(view)
    literal = spark.sql("""
        SELECT vendor, factor, factor_count, rank FROM (
          SELECT *, rank() OVER (PARTITION BY vendor ORDER BY factor_count DESC) AS rank FROM (
            SELECT vendor, factor, count(*) AS factor_count FROM (
              SELECT v.name AS vendor, explode(c.contributing_factor_list) AS factor
              FROM t JOIN v ON t.vendor_key = v.vendor_key JOIN d ON d.date_key = t.date_key
              JOIN l ON t.pickup_location_key = l.location_key OR t.drop_off_location_key = l.location_key
              JOIN c ON c.date_key = d.date_key AND c.location_key = l.location_key
              WHERE array_contains(c.vehicle_type_list, 'TAXI'))
            GROUP BY vendor, factor)) WHERE rank <= 2""")
    got = city.vendor_top_factors(*star, n=2).select("vendor", "factor", "factor_count", "rank")
    assert rows(got) == rows(literal)

    # the located crashes are taken from the first run
    (city_files / "zones.geojson").write_text("{}")
    run(reuse_located=True)
    assert spark.table("taxi_db.crash_dim").count() == 4
    spark.sql("DROP DATABASE taxi_db CASCADE")


def test_crash_rules(spark, city_files):
    from starloom.sources import read_csv_strings

    raw = read_csv_strings(spark, f"{city_files}/crashes.csv")
    assert city.clean_crashes(raw).count() == 5
    loose = city.clean_crashes(raw, required=["crash_date"], any_of=["latitude", "longitude"])
    assert loose.count() == 7
    assert city.clean_crashes(raw, date_format="dd/MM/yyyy").count() == 0


def test_songplays_matching_variants(spark, rows):
    events = spark.createDataFrame(
        [("Muse", "Uprising", 200.4, 1, 10), ("Queen", "Uprising", 99.0, 2, 20), ("X", "Y", 1.0, 3, 30)],
        "artist string, song string, length double, userId int, sessionId int",
    ).selectExpr("*", "'NextSong' page", "1541121934796L ts", "'free' level", "'NY' location", "'UA' userAgent")
    songs = spark.createDataFrame(
        [("S1", "A1", "Uprising", "Muse", 200.3), ("S2", "A2", "Uprising", "Queen", 98.0)],
        "song_id string, artist_id string, title string, artist_name string, duration double",
    )

    def ids(**options):
        return rows(music.songplays(events, songs, **options).select("user_id", "song_id"))

    assert ids(match_on=["title"]) == [(1, "S1"), (1, "S2"), (2, "S1"), (2, "S2")]
    assert ids() == [(1, "S1"), (2, "S2")]
    exact = {"match_on": ["title", "artist_name", "duration"], "how": "left"}
    assert ids(**exact) == [(1, None), (2, None), (3, None)]
    assert ids(**exact, duration_scale=0) == [(1, "S1"), (2, None), (3, None)]
    loaded = spark.createDataFrame([(1, 10)], "user_id int, session_id int")
    assert ids(existing=loaded) == [(2, "S2")]
    twice = songs.unionByName(songs.withColumn("duration", F.col("duration") + 1))
    assert rows(music.songplays(events, twice, key=None)) == rows(music.songplays(events, songs, key=None))
    with pytest.raises(ValueError):
        music.songplays(events, songs, key="uuid")


def test_overwrite_rejects_missing_columns(spark):
    spark.sql("DROP TABLE IF EXISTS one_col")
    spark.sql("CREATE TABLE one_col (a int) USING parquet")
    with pytest.raises(ValueError):
        overwrite_table(spark.range(1), "one_col")
    spark.sql("DROP TABLE one_col")
